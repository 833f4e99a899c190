import random

import pytest
from pyspark.sql import functions as F

from wavetrawl.operators import audio

SCHEMA = "recording_id string, channel int, t bigint, value double"


def _samples():
    rng = random.Random(3)
    rows = [("hot", c, t, float(rng.randrange(100))) for c in (0, 1) for t in sorted(rng.sample(range(-50, 900), 120))]
    rows += [("mono", 0, t, float(t * t)) for t in (3, 40, 41, 400)] + [("one", 0, 20, 5.0), ("none", 0, 21, 5.0)]
    return [*rows, ("mono", 0, 40, 2.0)]


def _brute_linear(rows, step):
    tracks = {}
    for rec, ch, t, v in rows:
        tracks.setdefault((rec, ch), {}).setdefault(t, []).append(v)
    out = {}
    for track, by_t in tracks.items():
        points = {t: sum(vs) / len(vs) for t, vs in by_t.items()}
        known = sorted(points)
        for t in range(-(-known[0] // step) * step, known[-1] + 1, step):
            a = max(k for k in known if k <= t)
            b = min(k for k in known if k >= t)
            out[(*track, t)] = points[a] if a == b else points[a] + (points[b] - points[a]) * (t - a) / (b - a)
    return out


@pytest.mark.parametrize("step, chunk", [(10, 16), (7, 1000), (10, 5), (1, 64)])
def test_resample_linear_equals_brute_force(spark, step, chunk):
    rows = _samples()
    got = audio.resample_linear(spark.createDataFrame(rows, SCHEMA), step, chunk_ticks=chunk).collect()
    expected = _brute_linear(rows, step)
    assert {(r.recording_id, r.channel, r.t) for r in got} == set(expected)
    assert len(got) == len(expected)
    assert all(r.value == pytest.approx(expected[(r.recording_id, r.channel, r.t)]) for r in got)


def test_resample_mean(spark):
    df = spark.createDataFrame([("a", 0, 0, 1.0), ("a", 0, 9, 3.0), ("a", 0, 10, 7.0), ("a", 1, -1, 9.0)], SCHEMA)
    rows = audio.resample_mean(df, 10).orderBy("channel", "t").collect()
    assert [tuple(r) for r in rows] == [("a", 0, 0, 2.0), ("a", 0, 10, 7.0), ("a", 1, -10, 9.0)]


def test_downmix_and_channels(spark):
    df = spark.createDataFrame([("s", 0, 1, 1.0), ("s", 1, 1, 4.0), ("m", 0, -70000, 3.0), ("m", 0, 70000, 5.0)], SCHEMA)
    assert {tuple(r) for r in audio.downmix(df).collect()} == {("s", 1, 2.5), ("m", -70000, 3.0), ("m", 70000, 5.0)}
    stereo = audio.to_stereo(df, chunk_ticks=100)
    assert stereo.filter("recording_id = 's'").count() == 2
    assert sorted((r.channel, r.t) for r in stereo.filter("recording_id = 'm'").collect()) == [
        (0, -70000), (0, 70000), (1, -70000), (1, 70000),
    ]
    assert audio.take_channel(stereo, 0).filter("channel <> 0").count() == 0


def test_cuts(spark):
    df = spark.createDataFrame([("a", 0, 0, 1.0), ("a", 0, 1, 1.0), ("b", 2, 0, 1.0), ("b", 5, 0, 1.0), ("c", 0, 0, 1.0)], SCHEMA)
    links = spark.createDataFrame([("a", "u", None, "d", "p", "ja"), ("b", "v", "t", "", "p", "")], "recording_id string, audio_url string, title string, description string, page_url string, language string")
    a, b = audio.build_cuts(audio.recording_facts(df, 4), links, 4).orderBy("id").collect()
    assert (a.id, a.start, a.duration, a.kind, a.channel) == ("a", 0.0, 0.5, "mono", [0])
    assert (b.kind, b.channel, b.recording.num_samples, b.recording.sampling_rate) == ("multi", [2, 5], 1, 4)
    assert a.custom == {"audio_url": "u", "title": "", "description": "d", "page_url": "p", "language": "ja"}


def test_outcomes(spark):
    items = spark.createDataFrame(
        [("a.wav", None, bytearray(b"x"), None), ("a.ogg", "audio/mpeg", bytearray(), None), ("a", None, None, "timeout"), ("a.AAC", "", None, "")],
        "audio_url string, content_type string, audio_data binary, error string",
    )
    outcomes = audio.item_outcomes(items)
    assert [(r.status, r.format) for r in outcomes.collect()] == [("ok", "wav"), ("empty", "mp3"), ("failed", "mp3"), ("empty", "mp3")]
    assert audio.usable_items(outcomes).count() + audio.dead_letters(outcomes).count() == 4
    assert outcomes.filter(F.col("status").isNull()).count() == 0
