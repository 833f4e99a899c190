"""Personal data in texts: exact patterns, and a skip-chain conditional random field that adds what they miss.

The patterns give the base spans. The field labels tokens with one of the kinds or none. Its tokens are those that can
carry personal data at all: with a digit or an "@", or equal to the name part of an address in the same document; all
others are fixed to none and only bound the chains. Potentials: features of a token (its shape and its neighbours'), the
labels of neighbouring tokens, and, along the skip chain, the labels of distant tokens that repeat or resemble each other.
Repeats are linked from one occurrence to the next, so a token that occurs n times has n - 1 links.

Tokens inside base spans are fixed to their kind; what the field says of the others comes from loopy message
passing over all documents of a batch at once. A run of tokens that are probably of one kind becomes a span if it also
has the form of that kind (:data:`FORMS`); base spans stay as they are, and no added span overlaps one. Less probability
is asked of tokens that are linked to a base span of that kind.

The weights are learned by pseudo-likelihood: given its neighbours' labels, each token's label is a soft-max
regression, so the fit needs single tokens and not whole documents. The base labels teach it; tokens outside base spans
that are linked to one teach nothing, as they are what the field is to decide. It is fitted on at most ``FIT_TOKENS``
tokens (those with the smallest hashes) of about ``FIT_DOCUMENTS`` documents that hold any.

All work per document is linear in its text. Memory grows with the number of tokens of the longest document, by some
kilobytes each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavetrawl.llm.common import ID, TEXT, id_and_text, quoted

KINDS = ("email", "ip", "card", "phone")
FIT_DOCUMENTS, FIT_TOKENS = 20_000, 40_000
# The least probability of an added span's tokens, and of those that a link ties to a base span of that kind.
THRESHOLD, LINKED_THRESHOLD = 0.9, 0.5
# What the weight of a skip link is drawn to where few links are seen.
SKIP_PRIOR = 5.0

_LABELS = len(KINDS) + 1  # the last label is "none"
_NONE = len(KINDS)
_FEATURES = 1 << 12
_ROUNDS, _DAMPING, _SETTLED = 30, 0.3, 1e-4

# What can hold a base span, and what can be a token of the field.
MAY_HOLD = "[0-9@]"
_TOKEN = re.compile(r"\S+")
_CANDIDATE = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+")

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NAME_PART = re.compile(r"[A-Za-z0-9._%+-]+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")

# The form an added span must have: near misses of the patterns, such as a phone number without its country code, or
# an address written so that programs do not find it. A number of a card's length counts only if it passes Luhn's test
# or is linked to a base card, such as one with a wrong digit.
FORMS = {
    "email": re.compile(r"[\w.%+-]+(?:@|\(at\)|\[at\])[\w-]+(?:(?:\.|\(dot\)|\[dot\])[\w-]+)+"),
    "ip": re.compile(r"[0-9]{1,3}(?:(?:\.|\[\.\]|\(\.\))[0-9]{1,3}){3}"),
    "card": re.compile(r"[0-9](?:[ .-]?[0-9]){14,18}"),
    "phone": re.compile(r"(?:00[1-9][0-9 ().-]+[0-9]|\(?[0-9]{2,4}\)?[ .-][0-9][0-9 .-]{4,12}[0-9])"),
}


def passes_luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _is_address(parts: list[str]) -> bool:
    plain = [part.lstrip("0") or "0" for part in parts]
    return all(len(part) < 4 and int(part) < 256 for part in plain)


def _trimmed(text: str, a: int, b: int) -> tuple[int, int]:
    """The span without the marks at its ends; brackets that belong to numbers stay."""
    while a < b and not (text[a].isalnum() or text[a] in "_+("):
        a += 1
    while a < b and not (text[b - 1].isalnum() or text[b - 1] in "_)"):
        b -= 1
    return a, b


def _plain(token: str) -> str:
    a, b = _trimmed(token, 0, len(token))
    return token[a:b].lower()


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches. Each "@" is looked at once, so texts without blanks cost no more than others."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and _NAME_PART.fullmatch(text, start - 1, start):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[list[tuple[int, int]]]:
    """The pattern matches of each kind, in code points, end exclusive."""
    ips = [m.span() for m in _IP.finditer(text) if _is_address(m[0].split("."))]
    cards = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() < 16:
            continue
        digits = "".join(_DIGIT.findall(m[0]))
        if 16 <= len(digits) <= 19 and passes_luhn(digits):
            cards.append(m.span())
    phones = [m.span() for m in _PHONE.finditer(text) if 8 <= len(_DIGIT.findall(m[0])) <= 15]
    return [list(_emails(text)), ips, cards, phones]


@dataclass
class Tokens:
    """The field's tokens of one document; ``labels`` is the base label or -1 for tokens outside base spans."""

    words: list[str]
    spans: list[tuple[int, int]]
    chained: np.ndarray  # whether the next token directly follows, with only blanks between
    links: np.ndarray  # pairs of tokens, the skip chain
    labels: np.ndarray
    names: set[str]  # the name parts of the base addresses

    def features(self) -> Iterator[list[int]]:
        """For each token, the numbers of its features."""
        shapes = [_shape(word) for word in self.words]
        for i, (word, shape) in enumerate(zip(self.words, shapes)):
            before = shapes[i - 1] if i and self.chained[i - 1] else ""
            after = shapes[i + 1] if self.chained[i] else ""
            found = (
                "bias", f"shape {shape}", f"edge {shape[:3]}", f"tail {shape[-4:]}",
                f"digits {min(len(_DIGIT.findall(word)), 20)}", f"dots {min(word.count('.'), 5)}", f"at {'@' in word}",
                f"before {before}", f"after {after}",
            )
            yield [crc32(name.encode("utf-8", "replace")) % _FEATURES for name in found]

    def linked_labels(self) -> np.ndarray:
        """For each token, how many links lead to base tokens of each kind and, last, to others."""
        label = np.where(self.labels < 0, _NONE, self.labels)
        counts = np.zeros((len(label), _LABELS), dtype=np.int64)
        for one, other in (self.links.T, self.links.T[::-1]):
            np.add.at(counts, (one, label[other]), 1)
        return counts


def _shape(token: str) -> str:
    plain = re.sub("[^\\W\\d_]", "a", re.sub("[0-9]", "0", token[:256]))
    return re.sub("a+", "a", plain)[:24]


def _cores(token: str) -> list[str]:
    """What a token is linked by: its plain form, an address's name part, its digits, and those with one left out."""
    plain = _plain(token)
    digits = "".join(_DIGIT.findall(plain))
    cores = {plain}
    if "@" in plain:
        cores.add(plain.split("@")[0])
    if 7 <= len(digits) <= 20:
        cores.add(digits)
        cores.update("~" + digits[:i] + digits[i + 1 :] for i in range(len(digits)))
    return sorted(core for core in cores if len(core) >= 4)


def tokens_of(text: str, base: list[list[tuple[int, int]]]) -> Tokens:
    names = {text[a:b].split("@")[0].lower() for a, b in base[0]}
    names = {name for name in names if len(name) >= 5}
    if names:
        found = (m for m in _TOKEN.finditer(text) if _CANDIDATE.match(m[0]) or _plain(m[0]) in names)
    else:
        found = _CANDIDATE.finditer(text)
    spans = [m.span() for m in found]
    words = [text[a:b] for a, b in spans]
    follows = [not text[a:b].strip() for (_, a), (b, _) in zip(spans, spans[1:])]
    chained = np.array(follows + [False] * bool(spans), dtype=bool)
    marks = sorted((a, b, kind) for kind, own in enumerate(base) for a, b in own)
    labels, at = np.full(len(spans), -1), 0
    for i, (a, b) in enumerate(spans):
        while at < len(marks) and marks[at][1] <= a:
            at += 1
        # Of overlapping base spans the one that starts first names the token.
        if at < len(marks) and marks[at][0] < b:
            labels[i] = marks[at][2]
    links, last = set(), {}
    for i, word in enumerate(words):
        for core in _cores(word):
            if core in last:
                links.add((last[core], i))
            last[core] = i
    pairs = np.array(sorted(links), dtype=np.int64).reshape(-1, 2)
    return Tokens(words, spans, chained, pairs, labels, names)


@dataclass
class Field:
    """Weights: by feature and label, of neighbouring labels, and of equal labels along a skip link."""

    unary: np.ndarray
    chain: np.ndarray
    skip: float

    @classmethod
    def empty(cls) -> Field:
        return cls(np.zeros((_FEATURES, _LABELS)), np.zeros((_LABELS, _LABELS)), 0.0)


def fit_field(tokens: pd.DataFrame, rounds: int = 200, rate: float = 0.5, shrink: float = 1e-4) -> Field:
    """Maximise the pseudo-likelihood of ``label`` given ``features, before, after, linked`` (label counts).

    ``before`` and ``after`` are the labels of chain neighbours, -1 where there is none. No tokens: no weights. The
    skip weight stays at 0 or more.
    """
    if not len(tokens):
        return Field.empty()
    wide = [np.stack(tokens[c].to_numpy()).astype(np.int64) for c in ("features", "linked")]
    flat = [tokens[c].to_numpy().astype(np.int64)[:, None] for c in ("label", "before", "after")]
    # Tokens alike in all that counts are one row.
    rows, times = np.unique(np.concatenate([*wide, *flat], axis=1), axis=0, return_counts=True)
    n_features = wide[0].shape[1]
    features, linked = rows[:, :n_features], rows[:, n_features : n_features + _LABELS].astype(float)
    label, before, after = rows[:, -3], rows[:, -2], rows[:, -1]
    share = (times / times.sum())[:, None]
    truth = np.eye(_LABELS)[label]
    has_before, has_after = before >= 0, after >= 0
    unary, chain, skip = parameters = [*vars(Field.empty()).values()][:2] + [np.array([SKIP_PRIOR])]
    squares = [np.full_like(p, 1e-8) for p in parameters]
    for _ in range(rounds):
        scores = unary[features].sum(axis=1) + skip * linked
        scores[has_before] += chain[before[has_before]]
        scores[has_after] += chain[:, after[has_after]].T
        likely = np.exp(scores - scores.max(axis=1, keepdims=True))
        wrong = (truth - likely / likely.sum(axis=1, keepdims=True)) * share
        steps = [np.zeros_like(p) for p in parameters]
        for c in range(_LABELS):
            spread = np.repeat(wrong[:, c], n_features)
            steps[0][:, c] = np.bincount(features.ravel(), weights=spread, minlength=_FEATURES)
        np.add.at(steps[1], before[has_before], wrong[has_before])
        np.add.at(steps[1].T, after[has_after], wrong[has_after])
        steps[2][0] = (wrong * linked).sum()
        for p, step, square, goal in zip(parameters, steps, squares, (0.0, 0.0, SKIP_PRIOR)):
            step -= shrink * (p - goal)
            square += step**2
            p += rate * step / np.sqrt(square)
        np.maximum(skip, 0.0, out=skip)
    return Field(unary, chain, float(skip[0]))


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


def marginals(unary: np.ndarray, edges: np.ndarray, potentials: np.ndarray) -> np.ndarray:
    """Label probabilities by loopy message passing: exact without loops, else to a fixed point or ``_ROUNDS``.

    ``edges`` are pairs of tokens, ``potentials`` one label-by-label table each.
    """
    n, e = len(unary), len(edges)
    belief = unary
    if e:
        source = np.concatenate([edges[:, 0], edges[:, 1]])
        target = np.concatenate([edges[:, 1], edges[:, 0]])
        table = np.concatenate([potentials, potentials.transpose(0, 2, 1)])
        back = np.concatenate([np.arange(e, 2 * e), np.arange(e)])
        messages = np.zeros((2 * e, _LABELS))
        for _ in range(_ROUNDS):
            inflow = np.stack([np.bincount(target, weights=messages[:, c], minlength=n) for c in range(_LABELS)], axis=1)
            belief = unary + inflow
            sent = _log_sum((belief[source] - messages[back])[:, :, None] + table, axis=1)
            sent -= _log_sum(sent, axis=1)[:, None]
            change = np.abs(sent - messages).max()
            messages = _DAMPING * messages + (1 - _DAMPING) * sent
            if change < _SETTLED:
                break
        belief = unary + np.stack(
            [np.bincount(target, weights=messages[:, c], minlength=n) for c in range(_LABELS)], axis=1
        )
    likely = np.exp(belief - belief.max(axis=1, keepdims=True))
    return likely / likely.sum(axis=1, keepdims=True)


def batch_marginals(documents: list[Tokens], field: Field) -> list[np.ndarray]:
    """The label probabilities of the tokens of each document, all documents in one run of message passing."""
    unary, edges, potentials, starts = [], [], [], [0]
    same = field.skip * np.eye(_LABELS)
    for tokens in documents:
        start, n = starts[-1], len(tokens.spans)
        own = np.array([field.unary[f].sum(axis=0) for f in tokens.features()]).reshape(n, _LABELS)
        fixed = tokens.labels >= 0
        own[fixed] = np.where(np.arange(_LABELS) == tokens.labels[fixed][:, None], 0.0, -50.0)
        chain = np.flatnonzero(tokens.chained)
        edges += [np.stack([chain, chain + 1], axis=1) + start, tokens.links + start]
        tables = ((field.chain, len(chain)), (same, len(tokens.links)))
        potentials += [np.broadcast_to(table, (k, _LABELS, _LABELS)) for table, k in tables]
        unary.append(own)
        starts.append(start + n)
    if not starts[-1]:
        return [np.zeros((0, _LABELS)) for _ in documents]
    likely = marginals(np.concatenate(unary), np.concatenate(edges), np.concatenate(potentials))
    return [likely[a:b] for a, b in zip(starts, starts[1:])]


def _has_form(kind: int, text: str, a: int, b: int, linked: bool, names: set[str]) -> bool:
    if KINDS[kind] == "email" and linked and text[a:b].lower() in names:
        return True
    if not FORMS[KINDS[kind]].fullmatch(text, a, b):
        return False
    if KINDS[kind] == "ip":
        return _is_address(re.findall("[0-9]+", text[a:b]))
    return KINDS[kind] != "card" or linked or passes_luhn("".join(_DIGIT.findall(text[a:b])))


def added_spans(
    text: str, tokens: Tokens, likely: np.ndarray, base: list[list[tuple[int, int]]], threshold: float = THRESHOLD
) -> list[list[tuple[int, int]]]:
    """Runs of neighbouring tokens that are probably of one kind and have its form.

    ``threshold`` is the least probability of tokens without a link to a base span of that kind.
    The name part of an address, where it stands alone, needs no other form than to be linked to that address.
    """
    found: list[list[tuple[int, int]]] = [[] for _ in KINDS]
    taken = sorted(span for spans in base for span in spans)
    linked = tokens.linked_labels()
    n, i, at = len(tokens.spans), 0, 0
    kinds = likely.argmax(axis=1) if n else np.zeros(0, dtype=int)
    least = np.where(linked[np.arange(n), kinds] > 0, min(LINKED_THRESHOLD, threshold), threshold)
    kinds[(tokens.labels >= 0) | (likely.max(axis=1, initial=0) < least)] = _NONE
    while i < n:
        kind, j = int(kinds[i]), i
        if kind != _NONE:
            while j + 1 < n and tokens.chained[j] and kinds[j + 1] == kind:
                j += 1
            a, b = _trimmed(text, tokens.spans[i][0], tokens.spans[j][1])
            while at < len(taken) and taken[at][1] <= a:
                at += 1
            free = a < b and (at == len(taken) or b <= taken[at][0])
            if free and _has_form(kind, text, a, b, bool(linked[i : j + 1, kind].any()), tokens.names):
                found[kind].append((a, b))
        i = j + 1
    return found


def _join(spans: list[list[tuple[int, int]]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, own in zip(KINDS, spans) for a, b in sorted(own))


def _fit_rows(text: Column) -> Column:
    """For each token of a document that teaches, what :func:`fit_field` needs."""
    kind = "array<struct<place: int, features: array<int>, label: int, before: int, after: int, linked: array<int>>>"

    @F.pandas_udf(kind)
    def rows(texts: pd.Series) -> pd.Series:
        result = []
        for text in texts:
            tokens = tokens_of(text, base_spans(text))
            label = np.where(tokens.labels < 0, _NONE, tokens.labels).tolist()
            linked = tokens.linked_labels()
            doubtful = (tokens.labels < 0) & (linked[:, :_NONE].sum(axis=1) > 0)
            result.append([
                {"place": i, "features": features, "label": label[i], "linked": linked[i].tolist(),
                 "before": label[i - 1] if i and tokens.chained[i - 1] else -1,
                 "after": label[i + 1] if tokens.chained[i] else -1}
                for i, features in enumerate(tokens.features()) if not doubtful[i]
            ])
        return pd.Series(result, dtype=object)

    return rows(text)


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Field:
    """Fit the field on a bounded sample of the tokens, by smallest hash."""
    rows = id_and_text(docs, id_col, text_col).filter(F.col(TEXT).rlike(MAY_HOLD))
    mark = F.xxhash64(F.coalesce(F.col(ID).cast("string"), F.lit("")), TEXT)
    share = min(1.0, FIT_DOCUMENTS / max(rows.count(), 1))
    some = rows.filter(F.pmod(mark, F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1))
    tokens = some.select(mark.alias("mark"), F.inline(_fit_rows(F.col(TEXT))))
    order = [F.xxhash64("mark", "place"), "mark", "place"]
    return fit_field(tokens.orderBy(*order).limit(FIT_TOKENS).toPandas())


_FOUND = "n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base string, spans string"


def _found(text: Column, field: Field, threshold: float) -> Column:
    @F.pandas_udf(_FOUND)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            result = [(0, 0, 0, 0, "", "")] * len(texts)
            held = [i for i, text in enumerate(texts) if text is not None]
            for at in range(0, len(held), 512):
                some = held[at : at + 512]
                bases = [base_spans(texts.iloc[i]) for i in some]
                documents = [tokens_of(texts.iloc[i], base) for i, base in zip(some, bases)]
                for i, base, tokens, likely in zip(some, bases, documents, batch_marginals(documents, field)):
                    extra = added_spans(texts.iloc[i], tokens, likely, base, threshold)
                    every = [own + more for own, more in zip(base, extra)]
                    result[i] = (*map(len, base), _join(base), _join(every))
            yield pd.DataFrame(result, columns=["n_email", "n_ip", "n_card", "n_phone", "base", "spans"])

    # Only texts that can hold anything go to Python.
    return found(F.when(text.rlike(MAY_HOLD), text))


def find_personal_data(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, field: Field | None = None
) -> DataFrame:
    """Columns ``doc_id, n_email, n_ip, n_card, n_phone, base, spans``, one row per input row.

    The counts are those of the base spans; ``base`` and ``spans`` (base and added ones) list ``kind:start:end`` by
    kind, then start, with commas between. Null and empty texts have none. Repeated rows each get a row. An empty
    table, or one without any base span, gives a field without weights, which adds nothing. ``field`` takes one that
    was fitted before.
    """
    known = learn(docs, id_col, text_col) if field is None else field
    rows = id_and_text(docs, id_col, text_col)
    return rows.select(F.col(ID).alias("doc_id"), _found(F.col(TEXT), known, threshold).alias("found")).select(
        "doc_id", "found.*"
    )


def mask_personal_data(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, field: Field | None = None
) -> DataFrame:
    """The documents with their own columns and each found span replaced by its kind in angle brackets.

    Where spans of two kinds overlap, they are replaced together by the first one's kind. Null texts stay null. A map
    without a shuffle, once the field is fitted.
    """
    known = learn(docs, id_col, text_col) if field is None else field

    @F.pandas_udf("string")
    def masked(texts: pd.Series, found: pd.DataFrame) -> pd.Series:
        result = []
        for text, listed in zip(texts, found["spans"]):
            if listed:
                marks = sorted((int(a), int(b), kind) for kind, a, b in (x.split(":") for x in listed.split(",")))
                parts, at = [], 0
                for a, b, kind in marks:
                    if a >= at:
                        parts += [text[at:a], f"<{kind}>"]
                    at = max(at, b)
                text = "".join([*parts, text[at:]])
            result.append(text)
        return pd.Series(result, dtype=object)

    text = masked(quoted(text_col), _found(quoted(text_col), known, threshold)).alias(text_col)
    return docs.select(*[text if c == text_col else quoted(c) for c in docs.columns])
