"""The text preparation operators: brute force on whole small tables, and edge rows."""

import hashlib
import zlib
from collections import Counter, defaultdict
from math import log10
from pathlib import Path

import compare
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from wavetrawl.llm import bpe, decontaminate, fixity, gam, katz, lines, quality, rules, simhash, tokens, toxicity
from wavetrawl.llm.common import read_table
from wavetrawl.llm.components import connected_components
from wavetrawl.llm.queries import QUERIES, SQL, vocabulary
from wavetrawl.session import checkpoint_root

SCHEMA = "doc_id bigint, text string, `__id` int, node string, root string"
LONG = "alpha beta gamma delta " * 4000
ODD_TEXTS = [None, "", " \n\t ", "one", "one", LONG, "é　漢字 <|endoftext|> x  \n \ny ", "A B C\nA B C\n"]
ODD = [(i % 6 if i < 7 else None, text, i, "n", "r") for i, text in enumerate(ODD_TEXTS)] + [(1, "", 9, "n", "r")]


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids and texts, empty and long texts, repeated rows, columns with clashing names."""
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, i % 2, 1 - i % 2) for i in range(6)] + [(None, 1, 0), (3, None, None)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="module")
def texts(spark, small):
    return {row["doc_id"]: row["text"] or "" for row in read_table(spark, small, "documents").collect()}


def groups(items, linked):
    root = {item: item for item in items}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    return {item: find(item) for item in items}


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 101 + i) for i in range(300)]
    frame = spark.createDataFrame([*chain, *star, (7, 7), (None, 3)], "a bigint, b bigint")
    found = {row["node"]: row["root"] for row in connected_components(frame, "a", "b").collect()}
    assert found == {**{i: 0 for i in range(1, 41)}, **{101 + i: 100 for i in range(300)}}


def test_every_pair_within_the_radius_meets_in_a_table():
    masks = simhash.covering_masks(2)
    assert len(masks) == 7
    for i in range(64):
        for j in range(i, 64):
            assert any(not (1 << i | 1 << j) & mask for mask in masks)


def test_simhash_links_like_brute_force(spark):
    rng = np.random.default_rng(4)
    centre = rng.integers(0, 1 << 63, 30, dtype=np.int64)
    prints = {int(c) ^ (1 << int(i)) ^ (1 << int(j)) for c in centre for i, j in rng.integers(0, 62, (40, 2))}
    frame = spark.createDataFrame([(x,) for x in prints], "fp bigint")
    linked = [tuple(row) for row in simhash.fingerprint_links(frame, 2).collect()]
    assert all((a ^ b).bit_count() <= 2 for a, b in linked)
    close = [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 2]
    assert groups(prints, linked) == groups(prints, close)


def test_op1_matches_brute_force(spark, small, texts):
    prints = {i: simhash.fingerprint_of(text, 3) for i, text in texts.items()}
    close = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    want = {i: (f"{prints[i]:016x}", root) for i, root in groups(prints, close).items()}
    rows = QUERIES["op1_simhash_near_dedup"](spark, small).collect()
    assert {row["doc_id"]: (row["fingerprint"], row["component_id"]) for row in rows} == want


def test_shingle_hash_is_the_engines(spark):
    from xxhash import xxh64_intdigest

    assert spark.sql("SELECT xxhash64('a b c')").first()[0] % (1 << 64) == xxh64_intdigest(b"a b c", 42)


def test_simhash_edges(spark, odd):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == len(ODD)
    assert {row["fingerprint"] for row in rows if row["doc_id"] == 0} >= {"0" * 16}
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns and kept.filter("coalesce(trim(text), '') = ''").count() <= 1
    assert simhash.near_duplicates(odd.limit(0)).count() == 0


def test_leaks_found_exactly(spark, small, texts):
    items = {row["item_id"]: decontaminate.normalise(row["text"]) for row in read_table(spark, small, "benchmark").collect()}
    plain = {i: decontaminate.normalise(text) for i, text in texts.items()}
    whole = {(i, item) for i, text in plain.items() for item, wanted in items.items() if wanted in text}
    rows = {(row["doc_id"], row["item_id"]): row for row in QUERIES["op2_benchmark_leaks"](spark, small).collect()}
    assert whole and whole <= set(rows)
    for (doc, item), row in rows.items():
        assert row["edits"] <= 12 and any(
            lines.edit_distance(w, plain[doc][s : s + len(w)]) <= 2 * 12
            for w in decontaminate.windows_of(items[item])
            for s in range(max(0, row["begin"] - 15), row["end"])
        )


def test_excerpts_are_found_at_every_offset(spark):
    items = [row["text"] for row in read_table(spark, "/root/testdata/sf0.1", "benchmark").collect()]
    items = [text for text in map(decontaminate.normalise, items) if len(text) >= 100][:30]
    index = decontaminate.BenchmarkIndex(list(enumerate(items)))
    least = decontaminate.LEAST_PASSAGE
    assert least <= 80
    rng = np.random.default_rng(13)
    cases = []
    for item, text in enumerate(items):
        for at in range(len(text) - least + 1):
            passage = text[at : at + least]
            cases.append((item, f"zq {passage} qz"))
            place = int(rng.integers(least))
            cases.append((item, f"zq {passage[:place]}#{passage[place + 1 :]} qz"))
    found = index.search([text for _, text in cases])
    assert len(cases) > 1000 and all(item in {row[0] for row in rows} for (item, _), rows in zip(cases, found))


def test_windows_like_brute_force():
    """Exactly the windows within the edit budget: every stretch of each text aligned with each window."""
    rng = np.random.default_rng(14)
    words = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(40)]
    items = [(n, " ".join(rng.choice(words, 14))) for n in range(6)]
    texts = []
    for _ in range(60):
        letters = list(items[rng.integers(6)][1])
        for _ in range(rng.integers(0, 14)):
            at = rng.integers(len(letters))
            letters[at] = rng.choice(["", "x", letters[at] + "y"])
        at = int(rng.integers(0, 30))
        texts.append(decontaminate.normalise(" ".join(rng.choice(words, 3)) + " " + "".join(letters)[at:]))

    def least_edits(window, text):
        cost = [0] * (len(text) + 1)
        for i, x in enumerate(window, 1):
            last, cost[0] = cost[0], i
            for j, y in enumerate(text, 1):
                last, cost[j] = cost[j], min(cost[j] + 1, cost[j - 1] + 1, last + (x != y))
        return min(cost)

    want = []
    for text in texts:
        counts = Counter()
        for item, whole in items:
            for window in decontaminate.windows_of(whole):
                counts[item] += least_edits(window, text) <= decontaminate.budget(len(window))[0]
        want.append({item: n for item, n in counts.items() if n})
    found = decontaminate.BenchmarkIndex(items).search(texts)
    assert [{row[0]: row[1] for row in rows} for rows in found] == want and any(want)


def test_leaks_with_edits_and_edges(spark, small, odd):
    item = read_table(spark, small, "benchmark").first()["text"]
    edited = item[:40] + "#" + item[41:90] + item[92:]
    docs = spark.createDataFrame([(1, "x " * 50 + edited.upper()), (2, "clean"), (3, None)], "doc_id bigint, text string")
    bench = spark.createDataFrame([(7, item), (8, None), (None, "x"), (9, "")], "item_id bigint, text string")
    assert [(row["doc_id"], row["item_id"]) for row in decontaminate.benchmark_matches(docs, bench).collect()] == [(1, 7)]
    assert decontaminate.drop_contaminated(odd, bench).count() == len(ODD)
    assert decontaminate.benchmark_matches(docs, bench.limit(0)).count() == 0


def test_maximal_segments_like_definition():
    rng = np.random.default_rng(1)
    for _ in range(200):
        scores = rng.normal(-0.2, 2, 14)  # without ties

        def split(a, b):
            best = max(((scores[i:j].sum(), -i, -j) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0, 0, 0))
            if best[0] <= 0:
                return []
            i, j = -best[1], -best[2]
            return split(a, i) + [best[0]] + split(j, b)

        assert sorted(s for s, _, _ in toxicity.segments(scores)) == pytest.approx(sorted(split(0, len(scores))))


def held_out_auc(rows, labels, column):
    pairs = [(row["score"], labels[row["doc_id"]][column]) for row in rows if row["held_out"] and row["doc_id"] in labels]
    good, bad = ([s for s, y in pairs if y == k] for k in (1, 0))
    return sum((a > b) + 0.5 * (a == b) for a in good for b in bad) / (len(good) * len(bad))


@pytest.mark.parametrize("name, column, least", [("op8_quality_gam", "quality", 0.98), ("op3_toxic_segments", "toxic", 0.9)])
def test_held_out_ranking(spark, name, column, least):
    sf = "/root/testdata/sf0.01"
    known = {row["doc_id"]: row.asDict() for row in read_table(spark, sf, "labels").collect()}
    rows = QUERIES[name](spark, sf).collect()
    assert all(row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 3 == 1) for row in rows)
    assert held_out_auc(rows, known, column) > least


def test_scores_of_edges(spark, odd, labels):
    for score in (quality.score_quality, toxicity.score_toxicity):
        for marks in (labels, labels.limit(0)):
            rows = score(odd, marks).collect()
            assert len(rows) == len(ODD) and all(0 <= row["score"] <= 1 for row in rows)
        assert score(odd.limit(0), labels).count() == 0


def test_additive_model_learns_a_pair():
    rng = np.random.default_rng(2)
    x = rng.random((600, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = gam.fit(x, y)
    assert ((model.probability(x) > 0.5) == y).mean() > 0.9


def brute_counts(model, texts):
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in texts}
    words = {i: text.encode().lower().split() + [b"\n"] for i, text in texts.items()}
    one, two = Counter(), Counter()
    for i, row in words.items():
        if not held[i]:
            one.update(row)
            two.update(zip(row, row[1:]))
    return held, words, one, two


def test_op4_matches_brute_force(spark, small, texts, monkeypatch):
    monkeypatch.setattr(katz, "CHUNK_TOKENS", 20_000)
    held, words, one, two = brute_counts(katz, texts)
    n, v = sum(one.values()), len(one)

    def factors(counts):
        by = Counter(counts.values())
        return dict(enumerate(katz.good_turing([by[r] for r in range(1, 7)])))

    f1, f2 = factors(one), factors(two)
    mass = sum(c * f1.get(c, 1) for c in one.values()) / n
    unknown = max(1 - mass, 1 / (n + 1))

    def p1(w):
        return (1 - unknown) / mass * one[w] * f1.get(one[w], 1) / n if one[w] else unknown

    kept, lower = defaultdict(float), defaultdict(float)
    for (h, w), c in two.items():
        kept[h] += c * f2.get(c, 1) / one[h]
        lower[h] += p1(w)

    def p2(h, w):
        if h not in kept:
            return p1(w)
        rest = max(1 - kept[h], 1 / (one[h] + 1))
        c = two[h, w]
        return (1 - rest) / kept[h] * c * f2.get(c, 1) / one[h] if c else rest / (1 - lower[h]) * p1(w)

    for h in list(kept)[:5]:
        assert sum(p2(h, w) for w in one) + p2(h, b"\0") == pytest.approx(1)
    rows = QUERIES["op4_katz_scores"](spark, small).collect()
    assert len(rows) == len(texts)
    for row in rows:
        own = words[row["doc_id"]]
        assert row["held_out"] == held[row["doc_id"]] and row["train_tokens"] == n
        assert row["n_tokens"] == len(own) and row["n_known"] == sum(one[w] > 0 for w in own)
        assert row["base_score"] == pytest.approx(sum(log10((one[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own))
        assert row["score"] == pytest.approx(log10(p1(own[0])) + sum(log10(p2(h, w)) for h, w in zip(own, own[1:])))


def test_katz_edges(spark, odd):
    rows = katz.score_texts(odd).collect()
    assert len(rows) == len(ODD) and all(row["score"] <= 0 for row in rows)
    assert katz.score_texts(odd.limit(0)).count() == 0
    assert all(row["score"] == 0 for row in katz.score_texts(odd, folds=1, held_out=0).collect())


def brute_measures(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times, covered = Counter(windows), set()
    for i, window in enumerate(windows):
        if times[window] > 1:
            covered |= {i, i + 1, i + 2}
    own = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(own) - len(set(own)), len(covered)


def test_op5_matches_brute_force(spark, small, texts):
    frame = QUERIES["op5_quality_rules"](spark, small)
    for row in frame.collect():
        assert tuple(row)[1:6] == brute_measures(texts[row["doc_id"]])
        assert row["base_failed"] == (row["n_words"] < 50 or 100 * row["n_repeat_words"] > 50 * row["n_words"])
        assert not (row["base_failed"] and row["kept"])
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_rules_bound_and_edges(spark, odd, labels):
    assert rules.binomial_tail(10, 0, 0.1) == pytest.approx(0.9**10)
    assert rules.binomial_tail(50_000, 0, 0.05) == pytest.approx(0, abs=1e-300)
    assert rules.binomial_tail(5, 5, 0.3) == 1
    rows = rules.apply_rules(odd, labels).collect()
    assert len(rows) == len(ODD) and not any(row["kept"] for row in rows)
    assert rules.apply_rules(odd.limit(0), labels.limit(0)).count() == 0


def exact_tail(n, k, p):
    from fractions import Fraction
    from math import comb

    rate = Fraction(p)
    return float(sum(comb(n, i) * rate**i * (1 - rate) ** (n - i) for i in range(k + 1)))


@pytest.mark.parametrize("n, p", [(1, 0.5), (40, 0.01), (300, 0.05), (700, 0.3)])
def test_binomial_tail_is_exact(n, p):
    for k in {0, 1, int(n * p), int(n * p) + 1, n // 2, n - 1}:
        assert rules.binomial_tail(n, min(k, n - 1), p) == pytest.approx(exact_tail(n, min(k, n - 1), p), rel=1e-9)


def test_binomial_tail_of_many_trials():
    from math import erf, sqrt

    for n, k in ((33_000, 916), (50_000, 1_390), (1_000_000, 27_800), (1_000_000, 999_999)):
        assert rules.binomial_tail(n, k, 0.05 / 7) == pytest.approx(1)
    n, p = 1_000_000, 0.01
    for k in (9_700, 9_900, 10_000, 10_100, 10_300):
        normal = (1 + erf((k + 0.5 - n * p) / sqrt(2 * n * p * (1 - p)))) / 2
        assert rules.binomial_tail(n, k, p) == pytest.approx(normal, abs=2e-3)
    assert 0 < rules.binomial_tail(n, 9_000, p) < 1e-20
    assert rules.binomial_tail(n, 100, 0.05) == 0


def test_rules_of_several_strata_and_texts_without_words(spark):
    def text(n, mark=""):
        return " ".join(f"w{i}{mark}" for i in range(n))

    good = [(i, text(60 if i % 2 else 200)) for i in range(3_000)]
    bad = [(5_000, None), (5_001, ""), (5_002, " \n "), (5_003, text(60, "#")), (5_004, text(200, "#")), (5_005, "##")]
    docs = spark.createDataFrame(good + bad, "doc_id bigint, text string")
    labels = spark.range(3_000).selectExpr("id AS doc_id", "1 AS quality")
    left = [row["doc_id"] for row in rules.apply_rules(docs, labels).collect() if not row["kept"]]
    assert sorted(left) == [i for i, _ in bad]


def test_op5_verdicts_match_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    texts = {row["doc_id"]: row["text"] or "" for row in read_table(spark, sf, "documents").collect()}
    good = {row["doc_id"] for row in read_table(spark, sf, "labels").collect() if row["quality"] == 1}
    measured = {}
    for i, text in texts.items():
        n, chars, symbols, dups, repeats = brute_measures(text)
        lines_ = sum(bool(line.strip(" \t\n\v\f\r")) for line in text.split("\n"))
        measured[i] = {
            "symbols": symbols / n if n else None, "dup_lines": dups / max(lines_, 1), "repeats": repeats / n if n else None,
            "long_words": chars / n if n else None, "short_words": chars / n if n else None,
            "capitals": sum(c.isupper() for c in text) / max(chars, 1),
            "exclamations": text.count("!") / n if n else None,
            "failed": n < 50 or 100 * repeats > 50 * n, "stratum": (n >= 150) + (n >= 500),
        }

    def beyond(rule, value, cutoff):
        return value is not None and (value > cutoff if rule.above else value < cutoff)

    level, chosen = rules.DELTA / (3 * len(rules.RULES)), {}
    for stratum in range(3):
        own = [m for i, m in measured.items() if i in good and not m["failed"] and m["stratum"] == stratum]
        for rule in rules.RULES:
            for cutoff in rule.cutoffs:
                lost = sum(beyond(rule, m[rule.name], cutoff) for m in own)
                if not own or exact_tail(len(own), lost, rules.RISK / len(rules.RULES)) > level:
                    break
                chosen[stratum, rule.name] = cutoff
    want = {
        i: not m["failed"]
        and not any(
            beyond(rule, m[rule.name], chosen[m["stratum"], rule.name])
            for rule in rules.RULES
            if (m["stratum"], rule.name) in chosen
        )
        for i, m in measured.items()
    }
    rows = QUERIES["op5_quality_rules"](spark, sf).collect()
    assert {row["doc_id"]: row["kept"] for row in rows} == want


def line_places(texts):
    places = defaultdict(list)
    for i, text in texts.items():
        for no, line in enumerate(text.split("\n")):
            if plain := lines.normalise_line(line):
                places[plain].append((i, no))
    return places


def similar(a, b):
    most = int(0.2 * max(len(a), len(b)) + 1e-9)
    return lines.edit_distance(a, b, most) <= most


def kept_texts(texts, places, linked):
    by_root = defaultdict(list)
    for line, root in groups(list(places), linked).items():
        by_root[root] += places[line]
    dropped = {place for found in by_root.values() for place in found if place != min(found)}
    return {
        i: "\n".join(line for no, line in enumerate(text.split("\n")) if (i, no) not in dropped) for i, text in texts.items()
    }


def test_line_dedup_leaves_no_used_up_tables(spark):
    line = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(1, line + "\nother words here"), (2, line.replace("five", "fife") + "\nkept by itself"), (3, line)]
    folder = Path(checkpoint_root(spark).removeprefix("file://")) / "wavetrawl"
    before = set(folder.glob("*"))
    cut = lines.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string"))
    left = {path.name.rsplit("-", 1)[0] for path in set(folder.glob("*")) - before}
    assert "dropped-lines" in left
    used_up = {"lines", "line-groups", "line-texts", "shared-keys", "shared-blocks", "met-lines", "crowd", "tried", "kept-lines"}
    assert not left & (used_up | {"wanted-lines", "rooted-lines", "decided-lines"})
    assert sorted(cut.collect()) == [(1, rows[0][1]), (2, "kept by itself"), (3, "")]


def test_op6_matches_brute_force(spark, small, texts):
    """Against all pairs by plain edit similarity: no line goes that should stay, and hardly one stays that should go."""
    places = line_places(texts)
    known = list(places)
    blocks = dict(zip(known, map(set, lines.BlockPrints().of(known))))
    plain = [(a, b) for n, a in enumerate(known) for b in known[n + 1 :] if similar(a, b)]
    near = [(a, b) for a, b in plain if len(blocks[a] & blocks[b]) > 1]
    assert len(plain) > 20 and len(near) >= 0.95 * len(plain)
    want = {i: Counter(text.split("\n")) for i, text in kept_texts(texts, places, plain).items()}
    rows = {row["doc_id"]: Counter(row["text"].split("\n")) for row in QUERIES["op6_line_dedup"](spark, small).collect()}
    assert all(want[i] <= rows[i] for i in texts)
    gone = sum(len(text.split("\n")) - want[i].total() for i, text in texts.items())
    kept_too_many = sum((rows[i] - want[i]).total() for i in texts)
    assert gone > 50 and kept_too_many <= 0.02 * gone, (kept_too_many, gone)


def edited(rng, line, share, words):
    units = line.split(" ") if words else list(line)
    for _ in range(max(1, int(share * len(units)))):
        units[rng.integers(len(units))] = "".join(rng.choice(list("本人日大行見中学" if "の" in line or "日" in line else "abcdefgh"), 1 if not words else 4))
    return (" " if words else "").join(units)


JA_LINES = (
    "今日は朝から雨が降っていたので家で本を読みました", "このラジオ番組は毎週金曜日の夜に放送されています",
    "新しい音声ファイルはこちらからダウンロードできます", "東京では桜の花が咲き始めて多くの人が公園に集まりました",
)


@pytest.mark.parametrize("low, high, share, words", [(3, 6, 0.1, False), (7, 14, 0.1, True), (15, 40, 0.1, True), (41, 90, 0.05, True)])
def test_edited_lines_agree_in_two_blocks(texts, low, high, share, words):
    """Recall of the blocks by length class, against plain edit similarity."""
    rng = np.random.default_rng(9)
    long = [line.split(" ") for line in line_places(texts) if line.count(" ") >= high]
    pairs = []
    for n in range(400):
        source = long[n % len(long)]
        line = " ".join(source[: rng.integers(low, high + 1)])
        other = edited(rng, line, share, words)
        if line != other and similar(line, other):
            pairs.append((line, other))
    prints = lines.BlockPrints()
    met = [len(set(a) & set(b)) > 1 for a, b in (prints.of(pair) for pair in pairs)]
    assert len(pairs) > 100 and sum(met) >= 0.9 * len(met), sum(met) / len(met)


def test_edited_japanese_lines_agree_in_two_blocks():
    rng = np.random.default_rng(10)
    for changes in (1, 2):
        pairs = []
        for n in range(200):
            line = "".join(rng.permutation(JA_LINES)[: 1 + n % 4])
            pairs.append((line, edited(rng, line, changes / len(line) + 1e-9, False)))
        prints = lines.BlockPrints()
        met = [len(set(a) & set(b)) > 1 for a, b in (prints.of(pair) for pair in pairs)]
        assert sum(met) >= 0.9 * len(met), (changes, sum(met) / len(met))


def test_unlike_lines_of_the_same_letters_take_no_edit_distance(monkeypatch):
    """Pairs of neighbouring letters tell them apart; similar lines are still found, whatever was edited."""
    rng = np.random.default_rng(16)
    unlike = ["".join(rng.permutation(list("abcdefghijklmnopqrstuvwxyz" * 4))) for _ in range(40)]
    calls, plain = [], lines.edit_distance
    monkeypatch.setattr(lines, "edit_distance", lambda *given: calls.append(given) or plain(*given))
    assert not list(lines.similar_in_tile(list(range(40)), unlike, [0] * 40, False, 0.8)) and not calls
    assert not lines.similar_pairs(unlike[1:], unlike[:-1], 0.8).any() and not calls
    near = [edited(rng, unlike[i % 40], share, False) for i, share in enumerate(np.linspace(0, 0.3, 200))]
    left = [unlike[i % 40] for i in range(200)] + ["", "a", "", "ab", "\U0001f600x"]
    right = [*near, "", "", "ab", "ba", "x\U0001f600"]
    want = [similar(a, b) for a, b in zip(left, right)]
    assert lines.similar_pairs(left, right, 0.8).tolist() == want and 50 < sum(want) < 200


def test_few_pairs_take_an_edit_distance(monkeypatch):
    """Lines of the same few syllables are told apart by bounds, and replaced words show that lines are similar."""
    rng = np.random.default_rng(18)
    syllables = ["th", "er", "on", "an", "re", "he", "in", "ed"]
    made = ["".join(str(rng.choice(syllables)) + " " * (k % 4 == 3) for k in range(100)).strip() for _ in range(120)]
    near = []
    for line in made:
        words = line.split(" ")
        words[rng.integers(len(words))] = "other"
        del words[rng.integers(len(words))]
        near.append(" ".join(words))
    calls, plain = [], lines.edit_distance
    monkeypatch.setattr(lines, "edit_distance", lambda *given: calls.append(given) or plain(*given))
    assert not lines.similar_pairs(made[1:], made[:-1], 0.8).any() and lines.similar_pairs(made, near, 0.8).all()
    assert not list(lines.similar_in_tile(list(range(120)), made, [0] * 120, False, 0.8))
    assert len(calls) < 0.02 * 120 * 120 / 2, len(calls)


def test_bounds_of_edit_distances():
    rng = np.random.default_rng(19)

    def text(n):
        return "".join(rng.choice(list("ab cé\U0001f600"), n))

    for _ in range(300):
        one = [text(rng.integers(0, 200)) for _ in range(5)]
        two = []
        for a in one:
            letters = list(a)
            for _ in range(rng.integers(0, 40)):
                at = rng.integers(len(letters) + 1)
                letters[at : at + rng.integers(2)] = list(text(rng.integers(2)))
            two.append("".join(letters))
        most = rng.integers(0, 45, 5)
        least = lines.least_edits(one, two, most)
        for a, b, limit, low in zip(one, two, most.tolist(), least.tolist()):
            edits, high = lines.edit_distance(a, b), lines.words_apart(a, b, limit)
            assert edits > limit or low <= edits
            assert high > limit or edits <= high
    assert lines.least_edits(["", "a", ""], ["", "", "a"], np.array([0, 1, 1])).tolist() == [0, 1, 0]
    assert lines.least_edits([], [], np.zeros(0, dtype=np.int64)).tolist() == []


def test_lines_are_normalised_together_as_one_by_one():
    rng = np.random.default_rng(20)
    letters = list("aB ΣσΑ9٣_-\n\r\t İß日の\ud800é\U0001f600")
    made = ["".join(rng.choice(letters, rng.integers(0, 30))) for _ in range(2000)]
    assert lines.normalised_lines(made) == [lines.normalise_line(line) for text in made for line in text.split("\n")]
    assert lines.normalised_lines([]) == [] and lines.normalised_lines([""]) == [""]


def test_tiles_taken_together_give_what_each_gives(monkeypatch):
    rng = np.random.default_rng(21)
    tiles = []
    for n in (2, 9, 40):
        base = ["".join(rng.choice(list("abcdefgh "), 60)) for _ in range(3)]
        tiles.append([edited(rng, base[i % 3], 0.12, False) for i in range(n)])
    given = [(list(range(len(texts))), texts, [i % 2 for i in range(len(texts))], across, 0.8) for texts in tiles for across in (False, True)]
    alone = [(no, *pair) for no, tile in enumerate(given) for pair in lines.similar_in_tile(*tile)]
    assert len(alone) > 50
    for most in (1, 1 << 18):
        monkeypatch.setattr(lines, "_MAX_LETTERS", most)
        assert sorted(lines.similar_in_tiles([lines._Tile(*tile) for tile in given])) == sorted(alone)
        for no, (_, texts, slots, across, _) in enumerate(given):
            linked = groups(range(len(texts)), [(i, j) for n, i, j in alone if n == no])
            for i, a in enumerate(texts):
                for j in range(i):
                    assert linked[i] == linked[j] or across and slots[i] == slots[j] or not similar(a, texts[j])


def test_lines_meet_by_their_keys(spark, monkeypatch):
    """Against plain counting, with lines given twice and portions of few keys."""
    rng = np.random.default_rng(22)
    monkeypatch.setattr(lines, "_MAX_KEYS", 64)
    hashes = rng.integers(-(2**63), 2**63 - 1, 400)
    chosen = [[*rng.choice(hashes[:30], 3, replace=False), *rng.choice(hashes[30:], 9, replace=False)] for _ in range(200)]
    nodes = [(int(hashes[i]), [int(key) for key in keys]) for i, keys in enumerate(chosen)]
    rows = spark.createDataFrame(nodes + nodes[::2], "line bigint, blocks array<bigint>")
    members = defaultdict(set)
    for line, keys in nodes:
        for key in keys:
            members[key].add(line)
    want, pairs = {}, Counter()
    for line, keys in nodes:
        met = [key for key in keys if len(members[key]) > 1]
        if len(met) > 1:
            want[line] = (sorted(k for k in met if len(members[k]) <= lines.SMALL), sorted(k for k in met if len(members[k]) > lines.SMALL))
    for key in members:
        own = sorted(line for line in members[key] if line in want and key in want[line][0])
        pairs.update((a, b, 2 if set(want[a][1]) & set(want[b][1]) else 1) for n, b in enumerate(own) for a in own[:n])
    met = lines._met_lines(rows)
    assert {r["line"]: (sorted(r["small"]), r["large"]) for r in met.collect()} == want
    found = met.repartition(1).mapInArrow(lines.dealt_small, "part int, rows binary, large binary").repartition("part")
    found = found.mapInArrow(lines.small_pairs, "a bigint, b bigint, weight int").collect()
    assert Counter(map(tuple, found)) == pairs and {w for _, _, w in pairs} == {1, 2}
    crowd = rows.mapInArrow(lines.dealt_keys, "part int, rows binary").repartition("part")
    crowd = crowd.mapInArrow(lines.shared_keys, "line bigint, key bigint, n bigint, end bigint").collect()
    assert sorted(map(tuple, crowd)) == sorted((line, k, len(own), min(own)) for k, own in members.items() if len(own) > 1 for line in own)
    assert lines._met_lines(rows.limit(0)).count() == 0
    two = rows.filter("size(blocks) > 1").mapInArrow(lines.dealt_twice, "part int, rows binary").repartition("part")
    two = two.mapInArrow(lines.shared_keys, "line bigint, key bigint, n bigint, end bigint").collect()
    pairs = defaultdict(set)
    for line, keys in nodes:
        for n, b in enumerate(keys):
            for a in keys[:n]:
                pairs[a, b].add(line)
    met = [own for own in pairs.values() if len(own) > 1]
    assert len(met) > 10 and Counter((r["line"], r["n"], r["end"]) for r in two) == Counter((x, len(own), min(own)) for own in met for x in own)


def test_blocks_as_bytes_are_those_as_numbers(spark, odd):
    docs = lines.id_and_text(odd).withColumn("key", lines.text_key(lines.F.col("__text")))
    plain = {(r["key"], r["no"], r["line"]): r["blocks"] for r in lines._line_rows(docs).collect()}
    packed = {(r["key"], r["no"], r["line"]): r["blocks"] for r in lines._line_rows(docs, packed=True).collect()}
    assert {k: None if x is None else np.frombuffer(bytes(x), np.int64).tolist() for k, x in packed.items()} == plain and plain
    met = lines._met_lines(lines._line_rows(docs, packed=True).filter("blocks IS NOT NULL").select("line", "blocks"))
    assert sorted(met.collect()) == sorted(lines._met_lines(lines._line_rows(docs).filter("blocks IS NOT NULL").select("line", "blocks")).collect())


def test_texts_without_lines_need_no_worker(spark):
    rows = [(0, "a\nb\n\nc\n", [1, 3]), (1, "a\nb", None), (2, "a", [0]), (3, "\n\n", [0, 2]), (4, "x\r\ny\\n", [])]
    frame = spark.createDataFrame(rows, "id int, text string, drop array<bigint>")
    frame = frame.withColumn("text", lines._without(lines.F.col("text"), lines.F.col("drop")))
    assert [r["text"] for r in frame.sort("id").collect()] == ["a\n\n", "a\nb", "", "", "x\r\ny\\n"]
    assert "Python" not in frame._jdf.queryExecution().executedPlan().toString()


def test_blocks_of_a_line_do_not_depend_on_the_lines_beside_it():
    """Nothing is kept between calls, and lines longer than one portion of features come out whole."""
    rng = np.random.default_rng(17)
    known = ["".join(rng.choice(list("abcd"), 3)) for _ in range(60)]
    made = [" ".join(rng.choice(known, n)) for n in (1, 5, 8, 9, 30, 300, 3000)] + ["日本語の文です", "größe über " * 9 + "x"]
    prints = lines.BlockPrints()
    together = prints.of(made)
    assert not vars(prints) and [prints.of([line])[0] for line in made] == together
    assert all(len(blocks) >= 1 for blocks in together) and prints.of([]) == []
    keys, ends = prints.flat(made)
    assert len(keys) == ends[-1] == sum(map(len, together))


def test_lines_given_twice_are_linked_once(spark):
    """Two tasks may each give the blocks of a line."""
    rows = [(i, f"alpha beta gamma delta epsilon zeta eta theta iota kappa {'one' if i else 'two'}") for i in range(2)]
    docs = spark.createDataFrame(rows, "__id bigint, __text string").withColumn("key", lines.text_key(lines.F.col("__text")))
    found = lines._line_rows(docs).collect()
    assert [row["no"] for row in found] == [0, 0] and all(row["blocks"] for row in found)
    places = spark.createDataFrame([(r["id"], r["key"], r["no"], r["line"]) for r in found], "id bigint, key bigint, no bigint, line bigint")
    nodes = spark.createDataFrame([(r["line"], r["blocks"]) for r in found * 3], "line bigint, blocks array<bigint>")
    names = sorted(row["line"] for row in found)
    assert [tuple(row) for row in lines.line_roots(nodes, places, docs, 0.8).collect()] == [(names[1], names[0])]


def test_large_groups_of_similar_lines_are_found(spark):
    """Buckets far larger than those that are paired out, with several groups in them and lines that belong nowhere."""
    rng = np.random.default_rng(11)
    vocabulary_ = ["".join(rng.choice(list("abcdefghijklmnop"), 6)) for _ in range(400)]
    common = list(rng.choice(vocabulary_, 20))
    bases = [common + list(rng.choice(vocabulary_, 20)) for _ in range(6)]
    rows = []
    for i in range(600):
        words = list(bases[i % 6])
        words[rng.integers(40)] = str(rng.choice(vocabulary_))
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join([*common[:10], *rng.choice(vocabulary_, 30)])) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    left = {row["doc_id"] for row in lines.dedup_lines(docs).collect() if row["text"]}
    places = line_places(dict(rows))
    known = list(places)
    want = kept_texts(dict(rows), places, [(a, b) for n, a in enumerate(known) for b in known[n + 1 :] if similar(a, b)])
    assert left == {i for i, text in want.items() if text} and len(left) < 120


def test_katz_blocks_take_little_more_than_their_hashes():
    """Of 100,000 n-grams, mostly seen once: hashes lose their leading zeros, and counts take little more than half a byte at most."""
    rng = np.random.default_rng(15)
    hashes = np.sort(rng.integers(0, 2**64 - 1, 100_000, dtype=np.uint64))
    counts = np.where(rng.random(100_000) < 0.97, 1, rng.integers(2, 300, 100_000))
    rows = list(katz._asked(0, 2, hashes, counts, 4))
    assert sum(len(row[4]) for row in rows) < 0.6 * len(hashes) and sum(len(row[3]) for row in rows) < 6.8 * len(hashes)


def test_every_pair_that_agrees_in_two_blocks_is_tried(spark, monkeypatch):
    """Two lines each that are similar, all in the same two large buckets, or in one large and one of their own."""
    from xxhash import xxh64_intdigest

    rng = np.random.default_rng(13)
    monkeypatch.setattr(lines, "TILE", 32, raising=False)
    texts, blocks = {}, []
    for i in range(300):
        words = ["".join(rng.choice(list("abcdefghijklmnop"), 6)) for _ in range(12)]
        for copy in range(2):
            texts[2 * i + copy] = " ".join([*words[: 12 - copy], *["other"] * copy])
            blocks.append([1, 2] if i < 150 else [3, 1000 + i])
    names = {i: int(np.uint64(xxh64_intdigest(text.encode(), 0)).astype(np.int64)) for i, text in texts.items()}
    docs = spark.createDataFrame(list(texts.items()), "__id bigint, __text string").withColumn("key", lines.text_key(lines.F.col("__text")))
    places = docs.selectExpr("__id AS id", "key", "0 AS no").join(spark.createDataFrame(list(names.items()), "id bigint, line bigint"), "id")
    nodes = spark.createDataFrame(list(zip(names.values(), blocks)), "line bigint, blocks array<bigint>")
    found = {(row["node"], row["root"]) for row in lines.line_roots(nodes, places, docs, 0.8).collect()}
    assert found == {(max(pair), min(pair)) for pair in ((names[2 * i], names[2 * i + 1]) for i in range(300))}


def test_frequent_words_do_not_rule_blocks():
    """Lines that share only how often their two commonest words come agree in few blocks, and a replaced word changes two."""
    rng = np.random.default_rng(14)
    rare = iter(["".join(rng.choice(list("abcdefghijklmnop"), 7)) for _ in range(4000)])
    made = [list(rng.permutation(["the"] * 20 + ["of"] * 15 + [next(rare) for _ in range(30)])) for _ in range(60)]
    blocks = [set(x) for x in lines.BlockPrints().of([" ".join(words) for words in made])]
    assert np.mean([len(a & b) > 1 for n, a in enumerate(blocks) for b in blocks[n + 1 :]]) < 0.05
    for words in made[:20]:
        other = list(words)
        other[words.index("the")] = "of"
        a, b = map(set, lines.BlockPrints().of([" ".join(words), " ".join(other)]))
        assert len(a - b) <= 2


def test_lines_edges(spark, odd):
    rows = lines.dedup_lines(odd)
    assert rows.columns == odd.columns and rows.count() == len(ODD)
    assert sum(row["text"].split("\n").count("A B C") for row in rows.collect()) == 1
    assert lines.dedup_lines(odd.limit(0)).count() == 0
    assert lines.edit_distance("kitten", "sitting") == 3 and lines.edit_distance("", "ab") == 2


def test_edit_distance_with_a_limit():
    rng = np.random.default_rng(12)

    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    for _ in range(400):
        a, b = ("".join(rng.choice(list("abc"), rng.integers(0, 20))) for _ in range(2))
        most = int(rng.integers(0, 12))
        assert lines.edit_distance(a, b) == plain(a, b)
        got = lines.edit_distance(a, b, most)
        assert got == plain(a, b) if plain(a, b) <= most else got > most


@pytest.mark.parametrize("name", ["own_key", "drop", "drop_id", "kept_id", "kept_key", "key", "line", "__id", "__text"])
def test_columns_of_the_same_names_stay(spark, name):
    rows = [(1, "a line of words", 5), (2, "a line of words", 6), (3, "b", 7)]
    docs = spark.createDataFrame(rows, f"doc_id bigint, text string, `{name}` int")
    assert sorted(row[name] for row in lines.dedup_lines(docs).collect()) == [5, 6, 7]
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and sorted(row[name] for row in kept.collect()) == [5, 7]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary())


def test_op7_matches_library(spark, small, texts, library):
    rows = {row["doc_id"]: row for row in QUERIES["op7_bpe_round_trip"](spark, small).collect()}
    for i, text in texts.items():
        ids = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), decoded)]
        assert [rows[i]["n_tokens"], rows[i]["ids_sha256"], rows[i]["decoded_sha256"]] == [len(ids), *digests]


def test_both_encoders_on_odd_texts(spark, odd, library):
    texts = [text or "" for text in ODD_TEXTS] + ["aaaa aaa", " a\n  b", "it's  we'll", "\n <|endoftext|>b", "\x85 \x1c x", "🙂z͑"]
    want = [library.encode(text, add_special_tokens=False).ids for text in texts]
    for encoder in (bpe.PairIndexBpe(vocabulary()), tokens.LibraryEncoder(vocabulary())):
        assert [x.tolist() for x in encoder.encode(texts)] == want
    path = vocabulary()
    back = odd.select("text", bpe.decode(bpe.encode(F.col("text"), path), path).alias("back"))
    assert all(row["back"] == (row["text"] or "") for row in back.collect())
    assert bpe.digests(odd.limit(0), path).count() == 0


def test_words_with_stops_are_encoded_once(library):
    texts = ["x alpha alpha, alpha. béta. alpha, x1, x1. a,b.", "alpha béta, gamma.\nalpha ..", "y alpha. \ud800, alpha"]
    encoder, asked = tokens.LibraryEncoder(vocabulary()), []
    chunks = encoder._chunks
    encode_new = chunks._encode_new
    chunks._encode_new = lambda new: asked.append(new) or encode_new(new)
    for _ in range(2):
        found = [x.tolist() for x in chunks.encode(texts[:2])]
        assert found == [library.encode(text, add_special_tokens=False).ids for text in texts[:2]]
    assert sorted(chunk for chunk in asked[0] if "alpha" in chunk) == [" alpha", " gamma.\nalpha", "alpha"]
    assert not any(chunk.startswith(" ") for chunk in asked[1])
    # Arrow cannot hold single surrogates: such a text is one chunk, the others are cut.
    own = bpe.PairIndexBpe(vocabulary())
    assert [x.tolist() for x in own.encode(texts)][:2] == found


def test_library_gets_bounded_texts_at_once(monkeypatch, library):
    monkeypatch.setattr(tokens, "_AT_ONCE", 1 << 12)
    monkeypatch.setattr(tokens, "_JOINED", 1 << 10)
    encoder, sizes = tokens.LibraryEncoder(vocabulary()), []

    class Watched:
        @staticmethod
        def encode_batch_fast(texts, **given):
            sizes.append(sum(map(len, texts)))
            return library.encode_batch_fast(texts, **given)

    encoder._library = Watched
    text = " ".join(f"w{i}q" for i in range(5_000))
    assert [x.tolist() for x in encoder.encode([text])] == [library.encode(text, add_special_tokens=False).ids]
    assert len(sizes) > 1 and max(sizes) < 1 << 13


def test_op10_matches_library(spark, small, texts, library):
    rows = {row["doc_id"]: row for row in QUERIES["op10_token_files"](spark, small).collect()}
    start = 0
    for i, text in sorted(texts.items()):
        ids = np.array(library.encode(text, add_special_tokens=False).ids + [0], dtype="<u4")
        assert (rows[i]["start"], rows[i]["n_tokens"], rows[i]["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_token_files_edges(spark, odd, tmp_path):
    rows = tokens.token_index(odd, vocabulary(), path=f"{tmp_path}/a").collect()
    assert len(rows) == len(ODD)
    order = sorted(rows, key=lambda row: row["start"])
    assert [row["doc_id"] is None for row in order[:2]] == [True, False]
    assert all(b["start"] == a["start"] + a["n_tokens"] for a, b in zip(order, order[1:]))
    one = tokens.read_tokens(spark, f"{tmp_path}/a", wanted=[3]).collect()
    assert {row["doc_id"] for row in one} == {3} and all(row["ids"][-1] == 0 for row in one)
    assert tokens.token_index(odd.limit(0), vocabulary()).count() == 0


def test_op9_matches_sql(spark, small):
    name = "op9_warc_fixity"
    con = compare.connect(small)
    assert compare.difference(QUERIES[name](spark, small), con, SQL[name]) is None


def test_audit_of_damaged_and_missing_archives(spark):
    def content(names):
        return b"".join(fixity.record_bytes(name, "http://x", name.encode() * 3) for name in names)

    names = [f"r{i}" for i in range(40)]
    whole = content(names)
    cut = bytearray(whole)
    cut[len(content(names[:20])) + 2] = 0
    left = [("a", whole), ("b", whole), ("c", whole), ("d", b""), (None, b"x")]
    right = [("a", whole), ("b", bytes(cut)), ("d", None)]
    frames = [spark.createDataFrame(x, "archive string, content binary") for x in (left, right)]
    found = Counter((row["archive"], row["status"]) for row in fixity.audit(*frames).collect())
    assert found == {("b", "missing"): 1, ("b", "extra"): 1, ("c", "missing"): 40}
    assert fixity.audit(frames[0], frames[0]).count() == 0
    assert fixity.audit(frames[0].limit(0), frames[0].limit(0)).count() == 0


def test_pipeline_stages(spark, small):
    docs = read_table(spark, small, "documents")
    columns = docs.columns
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialise(stage(spark, docs, small), name)
        assert docs.columns == columns and docs.count() <= before
    kept = {row["doc_id"] for row in docs.collect()}
    rows = corpus_pipeline.run(spark, small)
    assert rows.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert {row["doc_id"] for row in rows.collect()} == kept
    assert public_tokenizers.path("byte_bpe_50k.json") == vocabulary()
