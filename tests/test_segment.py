import random

import pytest
from pyspark.sql import functions as F

from cadenza import schemas
from cadenza.operators.dataset import contained, speaker_splits
from cadenza.operators.offsets import BLOCK_ROWS, blocked, clean_offsets, drop_blank_tokens, merge_on_delimiter, to_long, to_nested
from cadenza.operators.segment import insert_tags, merge_sounds, overlap_matches, phoneme_overlap_chunks, segment_bounds, shift_segment, silence_chunks, silence_segments, tagged_segments, word_overlap_chunks

LONG = "utt_id string, pos bigint, text string, start_time double, end_time double, offset_id bigint"


def one(spark, offsets, column):
    return spark.createDataFrame([(offsets,)], f"o {schemas.OFFSETS}").select(column(F.col("o")).alias("r")).first()["r"]


def spans(segments):
    return [[(o["start_time"], o["end_time"]) for o in s] for s in segments]


SPANS = [(0.0, 0.4), (0.4, 0.5), (0.6, 0.8), (1.1, 1.3), (1.5, 1.7), (1.7, 2.0)]


@pytest.mark.parametrize(("gap", "sizes"), [(0.2, [3, 1, 2]), (0.1, [2, 1, 1, 2]), (9.0, [6]), (0.0, [1] * 6)])
def test_silence(spark, gap, sizes):
    o = [("x", a, b) for a, b in SPANS]
    assert [len(s) for s in one(spark, o, lambda c: silence_chunks(c, gap))] == sizes
    rows = [("u", i, "x", a, b, i) for i, (a, b) in enumerate(SPANS)]
    got = segment_bounds(silence_segments(spark.createDataFrame(rows, LONG), gap)).orderBy("segment").collect()
    assert [r["n"] for r in got] == sizes
    assert [r["segment"] for r in got] == list(range(len(sizes)))


def test_silence_of_nothing(spark):
    assert one(spark, [], lambda c: silence_chunks(c, 0.1)) == [[]]
    assert silence_segments(spark.createDataFrame([], LONG), 0.1).count() == 0


def test_silence_long_form_meets_nested_form_across_blocks(spark):
    rng = random.Random(5)
    rows = []
    for u in range(4):
        t = 0.0
        for i in range(30):
            t += rng.choice([0.0, 0.05, 0.3, 0.301])
            e = round(t + rng.random() / 3, 3)
            rows.append((f"u{u}", i * (BLOCK_ROWS // 9), "x", round(t, 3), e, i))
            t = e
    df = spark.createDataFrame(rows, LONG)
    assert blocked(df).select("block").distinct().count() > 2
    nested = to_nested(df).select("utt_id", F.transform(silence_chunks(F.col("offsets"), 0.3), lambda s: F.size(s)).alias("n"))
    want = {r["utt_id"]: list(r["n"]) for r in nested.collect()}
    got = {}
    for r in segment_bounds(silence_segments(df, 0.3)).orderBy("utt_id", "segment").collect():
        got.setdefault(r["utt_id"], []).append(r["n"])
    assert got == want


def test_word_overlap(spark):
    o = [(w, float(i), i + 0.5) for i, w in enumerate("HER RED UMBRELLA IS JUST THE BEST".split())]
    got = one(spark, o, lambda c: word_overlap_chunks(c, F.split(F.lit("red umbrella just the best"), " ")))
    assert [[x["text"] for x in s] for s in got] == [["RED", "UMBRELLA"], ["JUST", "THE", "BEST"]]


def test_word_overlap_of_a_long_recording(spark, tmp_path):
    from cadenza.queries import word_overlap

    n = BLOCK_ROWS + 900
    said = [f"w{i}" for i in range(n)]
    said[BLOCK_ROWS + 500] = "w4090"  # the beginning of the truth once more, behind a border
    spark.createDataFrame([("a", i, w, float(i), i + 0.5, i) for i, w in enumerate(said)], LONG).write.parquet(str(tmp_path / "utt_offsets.parquet"))
    truth = " ".join(f"w{i}" for i in range(BLOCK_ROWS - 6, BLOCK_ROWS + 5))
    spark.createDataFrame([("x/a.wav", "a", truth), ("y/a.wav", "a", "w1 w2"), ("z/a.wav", "a", "")], "audio string, id string, ground_truth string").write.parquet(str(tmp_path / "utterances.parquet"))
    got = sorted((r["audio"], r["n"], r["start_time"], r["text"]) for r in word_overlap(spark, str(tmp_path)).collect())
    assert got == [("x/a.wav", 11, float(BLOCK_ROWS - 6), truth), ("y/a.wav", 2, 1.0, "w1 w2")]


SOUNDS = [
    ("h", 0.16, 0.18), ("ɝ", 0.26, 0.28), (" ", 0.3, 0.34), ("ɹ", 0.36, 0.38), ("ɛ", 0.44, 0.46), ("d", 0.5, 0.52), (" ", 0.6, 0.64), ("ə", 0.72, 0.74), ("m", 0.76, 0.78), ("b", 0.82, 0.84),
    ("ɹ", 0.84, 0.88), ("ɛ", 0.92, 0.94), ("l", 0.98, 1.0), ("ə", 1.12, 1.14), (" ", 1.3, 1.34), ("ɪ", 1.4, 1.42), ("z", 1.44, 1.46), (" ", 1.52, 1.56), ("dʒ", 1.58, 1.6), ("ʌ", 1.66, 1.68),
    ("s", 1.7, 1.72), ("t", 1.78, 1.8), (" ", 1.84, 1.88), ("θ", 1.88, 1.9), (" ", 1.96, 2.0), ("b", 2.0, 2.02), ("ɛ", 2.12, 2.14), ("s", 2.18, 2.2), ("t", 2.32, 2.34),
]
VARIANTS = [["h ɚ", "h ɜ ɹ", "ɜ ɹ", "ə ɹ"], ["ɹ ɛ d"], ["ʌ m b ɹ ɛ l ə"], ["ɪ z"], ["dʒ ʌ s t"], ["ð ə", "ð i", "ð ɪ"], ["b ɛ s t"]]


@pytest.mark.parametrize(
    ("sounds", "variants", "want"),
    [
        (SOUNDS, VARIANTS, [[("ɹ ɛ d", 0.36, 0.52)], [("ɪ z", 1.4, 1.46), ("dʒ ʌ s t", 1.58, 1.8)], [("b ɛ s t", 2.0, 2.34)]]),
        (SOUNDS[3:6], [["ɹ ɛ d"]], [[("ɹ ɛ d", 0.36, 0.52)]]),
        (SOUNDS[:2], VARIANTS[:1], []),
        (SOUNDS[:6], VARIANTS[:1], []),
        ([], VARIANTS, []),
    ],
)
def test_phoneme_overlap(spark, sounds, variants, want):
    df = spark.createDataFrame([(sounds, variants)], f"o {schemas.OFFSETS}, v array<array<string>>")
    got = df.select(phoneme_overlap_chunks(F.col("o"), F.col("v")).alias("r")).first()["r"]
    assert [[tuple(x) for x in s] for s in got] == want


def test_overlap_matches_by_brute_force(spark):
    rng = random.Random(7)
    rows = [([rng.choice("abc") for _ in range(rng.randint(0, 6))], [[rng.choice("abc")] for _ in range(rng.randint(0, 6))]) for _ in range(60)]
    got = spark.createDataFrame(rows, "w array<string>, v array<array<string>>").select("w", "v", overlap_matches(F.col("w"), F.col("v")).alias("m")).collect()
    for r in got:
        assert r["m"] == [i for i, x in enumerate(r["w"]) if i < len(r["v"]) and any(x in y for y in r["v"][i:])]


def test_merged_sounds_forms_agree(spark):
    rng = random.Random(8)
    rows = [(f"u{u}", i, rng.choice(["a", "b", " ", " "]), float(i), i + 0.5, i) for u in range(5) for i in range(rng.randint(1, 12))]
    df = spark.createDataFrame(rows, LONG)
    nested = to_nested(df).select("utt_id", F.posexplode(merge_sounds(F.col("offsets"))).alias("word", "o")).select("utt_id", "word", "o.text", "o.start_time", "o.end_time")
    long = merge_on_delimiter(df, F.col("text") == " ").select("utt_id", "word", "text", "start_time", "end_time")
    assert sorted(map(tuple, nested.collect())) == sorted(map(tuple, long.collect()))


def test_tags_and_shift(spark):
    o = [("a", 1.62, 1.64), ("b", 1.66, 1.7), ("c", 1.8, 1.9), ("d", 2.5, 2.6)]
    got = one(spark, o, lambda c: F.transform(silence_chunks(c, 0.3), lambda s: insert_tags(s, 0.1)))
    assert [[x["text"] for x in s] for s in got] == [["a", "b", "<EMPTY>", "c"], ["d"]]
    assert spans(one(spark, o, lambda c: F.array(shift_segment(F.slice(c, 1, 2)))))[0] == [(0.0, 0.02), (0.04, 0.08)]
    df = silence_segments(spark.createDataFrame([("u", i, *x, i) for i, x in enumerate(o)], LONG), 0.3, previous=True)
    assert [(r["start_time"], r["end_time"]) for r in tagged_segments(df, 0.1).filter("is_tag").collect()] == [(1.7, 1.8)]


def test_cleaning_and_converters(spark):
    rows = [("u", 0, "a", 0.0, 1.0, 5), ("u", 0, "a", 0.0, 1.0, 3), ("u", None, "a", 0.0, 1.0, 4), (None, 0, "a", 0.0, 1.0, 6), ("u", 1, None, 1.0, 2.0, 7), ("u", 2, "b", None, 2.0, 8)]
    df = spark.createDataFrame(rows, LONG)
    kept = sorted(r["offset_id"] for r in clean_offsets(df).collect())
    assert kept == [3, 7]
    back = to_long(to_nested(clean_offsets(df))).orderBy("pos").collect()
    assert [(r["pos"], r["text"]) for r in back] == [(0, "a"), (1, None)]
    got = one(spark, [(" ", 0.0, 0.1), (" a ", 0.12345, 0.2)], drop_blank_tokens)
    assert [tuple(x) for x in got] == [("a", 0.123, 0.2)]


def test_speaker_splits(spark):
    rows = [(s,) for s, n in (("a", 7), ("b", 1), ("c", 1), ("d", 1)) for _ in range(n)] + [(None,)] * 3
    got = {r["speaker"]: r["split"] for r in speaker_splits(spark.createDataFrame(rows, "speaker string")).collect()}
    assert got == {"a": "train", "b": "train", "c": "test", "d": "validation"}
    assert speaker_splits(spark.createDataFrame([], "speaker string")).count() == 0


def test_containment_by_brute_force(spark):
    rng = random.Random(9)
    outer = [(f"u{rng.randint(0, 2)}", i, rng.randint(0, 50) / 10, rng.randint(0, 50) / 10) for i in range(30)]
    inner = [(f"u{rng.randint(0, 2)}", a := rng.randint(0, 50) / 10, a + rng.randint(-10, 10) / 10, str(i)) for i in range(40)]
    got = contained(spark.createDataFrame(outer, "u string, i int, start_time double, end_time double"), spark.createDataFrame(inner, "u string, start_time double, end_time double, text string"), "u")
    want = set()
    for u, i, s, e in outer:
        hits = [t for v, a, b, t in inner if v == u and a >= s - 0.06 and b <= e + 0.06]
        want |= {(i, t) for t in hits} or {(i, None)}
    rows = got.select("i", "inner_text").collect()
    assert {tuple(r) for r in rows} == want
    assert len(rows) == len(want)


def test_phoneme_overlap_in_long_form(spark):
    from cadenza.operators.segment import phoneme_overlap_segments

    sounds = spark.createDataFrame([("a", i, t, s, e, i) for i, (t, s, e) in enumerate(SOUNDS)], LONG)
    variants = spark.createDataFrame([("a", len(VARIANTS), j, v) for j, vs in enumerate(VARIANTS) for v in vs], "utt_id string, m int, j int, heard string")
    got = sorted((r["start_time"], r["end_time"], r["n"]) for r in phoneme_overlap_segments(sounds, variants).collect())
    nested = one(spark, SOUNDS, lambda c: phoneme_overlap_chunks(c, F.array(*[F.array(*map(F.lit, vs)) for vs in VARIANTS])))
    assert got and got == [(s[0]["start_time"], s[-1]["end_time"], len(s)) for s in nested]


def test_phoneme_overlap_query_uses_the_lexicons_variants(spark, tmp_path):
    from cadenza.queries import phoneme_overlap

    # "read" and "red" differ as words and agree as sounds; "zork" is out of the lexicon
    spark.createDataFrame([("a", i, t, float(i), i + 0.5, i) for i, t in enumerate(["red", " ", "Zork", "blue"])], LONG).write.parquet(str(tmp_path / "utt_offsets.parquet"))
    spark.createDataFrame([("x/a.wav", "a", "read zork green"), ("y/a.wav", "a", "zork")], "audio string, id string, ground_truth string").write.parquet(str(tmp_path / "utterances.parquet"))
    lexicon = [("red", ["ɹ ɛ d"], "en"), ("read", ["ɹ iː d", "ɹ ɛː d"], "en"), ("blue", ["b l u"], "en"), ("green", ["ɡ ɹ i n"], "en")]
    spark.createDataFrame(lexicon, "word string, pronunciations array<string>, language string").write.parquet(str(tmp_path / "lexicon.parquet"))
    got = [(r["audio"], r["first_word"], r["n"], r["start_time"], r["end_time"]) for r in phoneme_overlap(spark, str(tmp_path)).collect()]
    assert got == [("x/a.wav", 0, 2, 0.0, 2.5)]
