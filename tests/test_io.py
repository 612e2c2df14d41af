import json
import math
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from cadenza.backends import DictionaryG2P, classify, get_g2p, register_g2p, spoken, transcribe, velar_nasal, wav_bytes, wav_duration, wav_samples
from cadenza.config import RunConfig, SegmenterConfig, TranscriberConfig
from cadenza.functions.text import aligner_form, letters_without_marks, number_words, numbers_spelled, phoneme_form, tokens, transcript_form
from cadenza.operators import audio
from cadenza.operators.lexicon import counts_by_word, lookup, merge_lexicons, missing_words, pronunciation_counts
from cadenza.plans.pipeline import keep_matching, recordings_to_segments
from cadenza.sources import readers, writers

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the stand-in models below travel to the workers


def text_of(spark, f, value):
    return spark.createDataFrame([(value,)], "t string").select(f(F.col("t"))).first()[0]


def test_text_functions(spark):
    assert text_of(spark, tokens, "Hello, please don't bug me!") == ["hello", "please", "don't", "bug", "me"]
    assert text_of(spark, tokens, "wait ... () what") == ["wait", "...", "what"]
    assert text_of(spark, transcript_form, "Hi, THERE <COMMA>  you-all\t") == "hi there  you all"
    assert text_of(spark, phoneme_form, " d͡ʒ ˈʌ s tː ") == "dʒ ʌ s t"
    assert text_of(spark, aligner_form, "Café № 1,2,  ok") == "cafe no twelve ok"
    assert text_of(spark, aligner_form, "It's  OK.") == "its ok" and text_of(spark, aligner_form, None) is None
    assert letters_without_marks("Ｃafé ﬁ") == "Cafe fi" and numbers_spelled("a 21 b") == "a twenty-one b"
    assert [number_words(n) for n in (0, 21, 105, 1001, 1999)] == ["zero", "twenty-one", "one hundred and five", "one thousand and one", "one thousand, nine hundred and ninety-nine"]


@pytest.mark.parametrize(
    "bad",
    [{"type": "seq2seq", "model": "m", "return_timestamps": "word"}, {"type": "wav2vec2", "model": "m", "return_timestamps": "phoneme", "chunk_length_s": 1}, {"type": "whisper", "model": "m", "return_timestamps": "word", "chunk_length_s": 1},
     {"type": "parakeet", "model": "m", "return_timestamps": "char"}, {"type": "whisper", "model": "m", "return_timestamps": True}],
)
def test_bad_transcribers(bad):
    with pytest.raises(ValueError):
        TranscriberConfig(**bad)


def test_config(tmp_path):
    with pytest.raises(ValueError):
        SegmenterConfig(type="foo")
    c = {"transcriber": {"type": "parakeet", "model": "m", "return_timestamps": "word"}, "segmenter": {"type": "silence"}, "do_noise_classify": True, "noise_classifier": {"model": "n"}}
    p = tmp_path / "c.json"
    p.write_text(json.dumps(c))
    r = RunConfig.load(str(p))
    assert (r.segmenter.silence_duration, r.noise_classifier.threshold, r.classifier) == (0.0, 0.3, None)
    with pytest.raises(TypeError):
        RunConfig.from_dict(c | {"segmenter": {"type": "silence", "nope": 1}})


def test_sources(spark, tmp_path):
    d = tmp_path / "en-us"
    d.mkdir()
    (d / "ann_1.wav").write_bytes(wav_bytes(np.zeros(1600)))
    (d / "ann_2.wav").write_bytes(b"")
    (d / "bob_1.wav").write_bytes(wav_bytes(np.zeros(800)))
    (d / "ann_1.txt").write_text("hello there")
    u = readers.utterances_from_folder(spark, str(tmp_path)).collect()
    assert [tuple(r)[1:] for r in u] == [("ann_1", "en-us", "en", "hello there")]
    with pytest.raises(ValueError):
        readers.audio_files(spark, str(tmp_path), "aac")
    m = tmp_path / "m.json"
    m.write_text(json.dumps([{"audio": "a/fr-fr/x_1.wav", "text": "oui"}, {"audio": "a/b/y.wav", "text": ""}, {"audio": "a/fr-ca/z.wav", "text": "non", "id": "k", "accent": "fr-ca", "language": "fr"}]))
    got = sorted(tuple(r) for r in readers.utterances_from_manifest(spark, str(m)).collect())
    assert got == [("a/fr-ca/z.wav", "k", "fr-ca", "fr", "non"), ("a/fr-fr/x_1.wav", "x_1", "fr-fr", "fr", "oui")]
    m.write_text("{not json")
    with pytest.raises(ValueError):
        readers.utterances_from_manifest(spark, str(m))
    (tmp_path / "l.jsonl").write_text('{"text": "a"}\n\n{}\nbroken\n')
    assert [r["text"] for r in readers.json_lines(spark, str(tmp_path / "l.jsonl"), "text string").collect()] == ["a"]
    o = tmp_path / "o"
    o.mkdir()
    (o / "a.json").write_text(json.dumps([{"start_time": 0, "text": "x", "end_time": 1.5}]))
    (o / "b.json").write_text("[]")
    (o / "c.json").write_text(json.dumps([{"text": "x", "start_time": 0}]))
    assert [tuple(r["offsets"][0]) for r in readers.offsets_json(spark, str(o)).collect()] == [("x", 0.0, 1.5)]
    (o / "a.tsv").write_text('0.0\t1.0\t"so"\n1.0\t2.0\twhat\n')
    assert readers.tsv_text(readers.transcript_tsv(spark, str(o))).first()["text"] == "so what"
    (o / "x.ctm").write_text("u 1 0.5 0.25 hi\nbad line\n")
    assert [tuple(r) for r in readers.ctm(spark, str(o / "x.ctm")).collect()] == [("u", "1", 0.5, 0.75, "hi")]
    t = spark.createDataFrame([("a", "en", None), ("b", "en", "2024"), ("c", "id", None)], "word string, language string, deletedAt string")
    assert [r["word"] for r in readers.lexicon_rows(t, "en").collect()] == ["a"]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("w", "t", "x"), (None, None, None)], "wav_path string, tsv_path string, text string")
    assert writers.write_manifest(rows, str(tmp_path / "m"))
    assert spark.read.json(str(tmp_path / "m")).count() == 1
    assert not writers.write_manifest(rows.filter("text is null"), str(tmp_path / "n"))
    assert not (tmp_path / "n").exists()
    nested = spark.createDataFrame([([[("a",), None], []],)], "x array<array<struct<text:string>>>")
    assert [r["text"] for r in writers.flatten_manifest(nested, "x").collect()] == ["a"]
    o = spark.createDataFrame([(f"{tmp_path}/s/a.tsv", [("hi", 0.0, 0.5)])], "p string, o array<struct<text:string,start_time:double,end_time:double>>")
    writers.write_files(o.select("p", writers.tsv_content("o").alias("c")), "p", "c")
    assert (tmp_path / "s/a.tsv").read_text() == "0.0\t0.5\thi\n"
    sent = []
    assert writers.push_batches([{"i": i} for i in range(25)], lambda b: sent.append(len(b)) or len(sent) < 3) == 20
    c = counts_by_word(pronunciation_counts(spark.createDataFrame([("w", "ɛ"), ("w", "ɛ"), ("w", "a")], "word string, phoneme string")))
    writers.write_counts(c, str(tmp_path / "c"))
    assert [json.loads(r["value"])["counts"] for r in spark.read.text(str(tmp_path / "c")).collect()] == [{"a": 1, "ɛ": 2}]


def test_audio_and_plans(spark):
    x = np.sin(np.arange(1600) / 10)
    samples, rate = wav_samples(wav_bytes(x))
    assert rate == 16_000 and np.abs(samples - x).max() < 1e-3 and math.isclose(wav_duration(wav_bytes(x)), 0.1)
    from cadenza.operators.audio import fixed_chunks, long_enough, strided_chunks

    for chunk, left, right in ((30, None, None), (30, 5, 0), (10, 0, 0), (12, 4, 4)):
        x, y = (round(chunk / 6) if left is None else left), (round(chunk / 6) if right is None else right)
        sizes = [0, 1, 5, 29, 30, 31, 60, 100]
        got = {r["n"]: [tuple(c) for c in r["c"]] for r in spark.createDataFrame([(n,) for n in sizes], "n int").select("n", strided_chunks(F.col("n"), chunk, left, right).alias("c")).collect()}
        for n in sizes:
            want = []
            for a in range(0, n, chunk - x - y):
                end, own = min(a + chunk, n), 0 if a == 0 else x
                last = a + chunk >= n if y == 0 else a + chunk > n
                if end - a > own:
                    want.append((a, end, own, 0 if last else y))
                if last:
                    break
            assert got[n] == want
    with pytest.raises(ValueError):
        strided_chunks(F.col("n"), 5, 3, 3)
    df = spark.createDataFrame([("a", 1300), ("b", 1400), ("c", 0), ("d", None)], "u string, n int")
    assert sorted(tuple(r) for r in fixed_chunks(df, "n", 500).select("u", "first_sample", "end_sample").collect()) == [("a", 0, 500), ("a", 500, 1000), ("b", 0, 500), ("b", 500, 1000), ("b", 1000, 1400)]
    assert [r[0] for r in spark.createDataFrame([([0.0] * 5,), ([0.0] * 6,)], "x array<double>").select(long_enough(F.col("x"), 5)).collect()] == [False, True]


def test_converters(spark):
    assert velar_nasal("ng'ombe", ["ᵑg", "o", "m", "b", "e"]) == ["ŋ", "o", "m", "b", "e"]
    assert velar_nasal("ngong'o", ["ᵑg", "o", "ᵑg", "o"]) == ["ᵑg", "o", "ŋ", "o"]
    assert velar_nasal("ng'ong'o", ["ᵑg", "o"]) == ["ᵑg", "o"]
    assert get_g2p("sw-TZ", {"ng'ombe": "ᵑg o m b e"}).phonemes("Ng'ombe, hi.") == ["ŋ o m b e", ",", "h i", "."]
    assert get_g2p("en-US", {"a": "ə"}).phonemes("a b") == ["ə", "b"]
    with pytest.raises(NotImplementedError):
        get_g2p("xx", {})
    register_g2p("xx", lambda words: DictionaryG2P(words | {"q": "k"}))
    assert get_g2p("XX-yy", {}).phonemes("q") == ["k"]
    words = spark.createDataFrame([("w",), ("zz",), (None,)], "word string")
    lex = spark.createDataFrame([("w", ["x"])], "word string, pronunciations array<string>")
    got = {r["word"]: r["pronunciations"] for r in lookup(words, lex, fallback=spoken(lambda: get_g2p("en", {"zz": "z z"}))).collect()}
    assert got["w"] == ["x"] and got["zz"] == ["z z"]


def test_more_sources(spark, tmp_path):
    d = tmp_path / "en-gb"
    d.mkdir()
    for n in ("a", "b"):
        (d / f"{n}.wav").write_bytes(wav_bytes(np.zeros(1600)))
        (d / f"{n}.mp3").write_bytes(b"x")
    (d / "e.wav").write_bytes(b"")
    (d / "a.txt").write_text("hi")
    (tmp_path / "practiceError").mkdir()
    (tmp_path / "practiceError" / "c.wav").write_bytes(b"x")
    assert [r["text"] for r in readers.audio_with_text(spark, str(tmp_path)).collect()] == ["hi"]
    files = readers.audio_files(spark, str(tmp_path))
    assert {r["audio"].rsplit("/", 1)[1] for r in readers.language_folders(files, ("en", "id")).collect()} == {"a.wav", "b.wav"}
    m = tmp_path / "m.json"
    m.write_text(json.dumps([{"audio": str(d / "a.wav"), "text": "x"}, {"audio": str(d / "e.wav"), "text": "y"}, {"audio": str(d / "none.wav"), "text": "z"}]))
    assert [r["ground_truth"] for r in readers.utterances_from_manifest(spark, str(m), files).collect()] == ["x"]
    assert readers.json_lines(spark, str(tmp_path / "missing.jsonl"), "text string").count() == 0
    (tmp_path / "ctm").mkdir()
    (tmp_path / "ctm" / "a.ctm").write_text("a 1 1.0 0.5 two\na 1 0.0 0.5 one\n")
    (tmp_path / "out.jsonl").write_text(json.dumps({"audio_filepath": "x/a.wav", "text": "one two", "words_level_ctm_filepath": str(tmp_path / "ctm/a.ctm")}) + "\n" + json.dumps({"audio_filepath": "x/b.wav"}) + "\n")
    aligned = readers.aligned_offsets(spark, str(tmp_path / "out.jsonl"), str(tmp_path / "ctm"))
    assert [(r["audio"], [tuple(o) for o in r["offsets"]]) for r in aligned.collect()] == [("x/a.wav", [("one", 0.0, 0.5), ("two", 1.0, 1.5)])]
    from cadenza.operators.dataset import by_base_name, preferred_text, without_partner

    found = {r["audio"]: len(r["offsets"]) for r in by_base_name(spark.createDataFrame([("q/a.wav",), ("q/z.wav",)], "audio string"), aligned).collect()}
    assert found == {"q/a.wav": 2, "q/z.wav": 0}
    one = lambda *rows: spark.createDataFrame(list(rows), "k string, text string")
    got = {r["k"]: r["text"] for r in preferred_text(one(("a", "-"), ("b", "-"), ("c", "-")).select("k"), "k", one(("a", "json")), one(("a", "txt"), ("b", "txt"))).collect()}
    assert got == {"a": "json", "b": "txt", "c": None}
    assert [r["k"] for r in without_partner(one(("a", ""), ("b", "")), one(("a", ""), ("b", "")), one(("a", "")), on="k").collect()] == ["b"]
    (tmp_path / "lex.json").write_text(json.dumps({"w": ["x y", "x"]}))
    assert [tuple(r) for r in readers.json_lexicon(spark, str(tmp_path / "lex.json")).collect()] == [("w", ["x y", "x"])]


def test_more_sinks(spark, tmp_path):
    o = spark.createDataFrame([("a.wav", [("hé", 0.0, 0.5), (None, 0.5, 1.0)])], "wav_path string, offsets array<struct<text:string,start_time:double,end_time:double>>")
    text = o.select(writers.offsets_content("offsets")).first()[0]
    assert "\n" in text and "hé" in text and json.loads(text)[1] == {"text": None, "start_time": 0.5, "end_time": 1.0}
    assert tuple(writers.explorer_manifest(o).first()) == ("a.wav", 1.0, "hé")
    rows = spark.createDataFrame([("w", "t"), (None, None), ("é", None)], "a string, b string")
    assert writers.array_manifest(rows, str(tmp_path / "m.json"))
    assert json.loads((tmp_path / "m.json").read_text(encoding="utf-8")) == [{"a": "w", "b": "t"}, {"a": "é"}]
    nested = spark.createDataFrame([([[("a",), None], [("b",)]],), ([],)], "x array<array<struct<text:string>>>")
    assert [r["items"] for r in writers.count_items(nested, "x").collect()] == [2, 0]
    assert not writers.array_manifest(rows.limit(0), str(tmp_path / "n.json")) and not (tmp_path / "n.json").exists()


def test_run_command(spark, tmp_path):
    from argparse import Namespace

    from cadenza.__main__ import run

    d = tmp_path / "in" / "en-us"
    d.mkdir(parents=True)
    (d / "ann_1.wav").write_bytes(wav_bytes(np.zeros(16_000 * 3), 16_000))
    (d / "ann_1.txt").write_text("one two three")
    (d / "ann_1.json").write_text(json.dumps([{"text": "one", "start_time": 0.5, "end_time": 0.9}, {"text": "two", "start_time": 1.0, "end_time": 1.4}, {"text": "three", "start_time": 2.6, "end_time": 2.99}]))
    config = tmp_path / "config.json"
    config.write_text(json.dumps({"transcriber": {"type": "wav2vec2", "model": "m", "return_timestamps": "word", "chunk_length_s": 30}, "segmenter": {"type": "silence", "silence_duration": 0.5, "minimum_chunk_duration": 0.3}}))
    out = tmp_path / "out"
    a = Namespace(input=str(tmp_path / "in"), output=str(out), config=str(config), audio=None, offsets=str(tmp_path / "in"), lexicon=None, transcriber=None, classifier=None, noise=None, g2p=None)
    assert run(spark, a) == 2
    assert (out / "en-us/ann_1-0.tsv").read_text() == "0.0\t0.4\tone\n0.5\t0.9\ttwo\n"
    assert wav_duration((out / "en-us/ann_1-0.wav").read_bytes()) == pytest.approx(0.95)
    assert wav_duration((out / "en-us/ann_1-1.wav").read_bytes()) == pytest.approx(0.4)  # no further than the recording
    assert {r["text"] for r in spark.read.json(str(out / "manifest")).collect()} == {"one two three"}


def test_lexicons(spark):
    a = spark.createDataFrame([("w", ["x", "y"]), ("v", None), (None, ["z"])], "word string, pronunciations array<string>")
    b = spark.createDataFrame([("w", ["y", "z", None]), ("u", ["q"])], "word string, pronunciations array<string>")
    assert {r["word"]: r["pronunciations"] for r in merge_lexicons(a, b).collect()} == {"w": ["x", "y", "z"], "u": ["q"]}
    words = spark.createDataFrame([("w",), ("k",), (None,)], "word string")
    assert {r["word"]: (r["known"], r["pronunciations"]) for r in lookup(words, a).collect()}["k"] == (False, ["k"])
    assert [r["word"] for r in missing_words(words, a).collect()] == ["k"]


class _Said:
    def transcribe(self, audio):
        if "bad" in audio:
            return None
        return [("red", 0.0, 0.4), (" ", 0.4, 0.45), ("hat", 0.5, 0.8), ("then", 2.0, 2.5)]


class _Child:
    def scores(self, audio):
        return [("child", 0.9), ("adult", 0.1)] if "kid" in audio else [("adult", 1.0)]


def test_end_to_end(spark):
    u = spark.createDataFrame([("d/en-us/kid_1.wav", "i", "en-us", "en", "red hat"), ("d/en-us/kid_bad.wav", "j", "en-us", "en", "x"), ("d/en-us/old_1.wav", "k", "en-us", "en", "y")], "audio string, id string, language_code string, language string, ground_truth string")
    base = {"transcriber": {"type": "parakeet", "model": "m", "return_timestamps": "word"}, "do_classify": True, "classifier": {"model": "c"}}
    silence = RunConfig.from_dict(base | {"segmenter": {"type": "silence", "silence_duration": 1.0}})
    got = recordings_to_segments(u, silence, _Said, "out", _Child).orderBy("segment").collect()
    assert [(r["wav_path"], [x["text"] for x in r["offsets"]], r["text"]) for r in got] == [("out/en-us/kid_1-0.wav", ["red", "hat"], "red hat then"), ("out/en-us/kid_1-1.wav", ["then"], "red hat then")]
    assert tuple(got[1]["offsets"][0])[1:] == (0.0, 0.5)
    short = RunConfig.from_dict(base | {"segmenter": {"type": "silence", "silence_duration": 1.0, "minimum_chunk_duration": 0.6}})
    assert [r["segment"] for r in recordings_to_segments(u, short, _Said, "out", _Child).collect()] == [0]
    words = RunConfig.from_dict(base | {"segmenter": {"type": "word_overlap"}})
    assert [[x["text"] for x in r["offsets"]] for r in recordings_to_segments(u, words, _Said, "out", _Child).collect()] == [["red", "hat"]]
    with pytest.raises(ValueError):
        recordings_to_segments(u, silence, _Said, "out")
    assert classify(u, _Child, threshold=2.0).filter(F.size("scores") == 0).count() == 3
    assert transcribe(u, _Said).filter("offsets is null").count() == 1


class _Noise:
    def scores(self, audio, start, end):
        return [("music", 0.6), ("bird", 0.6)] if end > 1.5 else [("music", 0.1)]


def test_noise_labels(spark):
    u = spark.createDataFrame([("d/en-us/kid_1.wav", "i", "en-us", "en", "x")], "audio string, id string, language_code string, language string, ground_truth string")
    c = {"transcriber": {"type": "parakeet", "model": "m", "return_timestamps": "word"}, "segmenter": {"type": "silence", "silence_duration": 9.0}, "do_noise_classify": True, "noise_classifier": {"model": "n", "minimum_empty_duration": 0.1}}
    r = recordings_to_segments(u, RunConfig.from_dict(c), _Said, "out", noise=_Noise).collect()
    assert [[x["text"] for x in s["offsets"]] for s in r] == [["red", "<EMPTY>", "hat", "<bird>", "then"]]


def test_cut_audio(spark, tmp_path):
    (tmp_path / "a.wav").write_bytes(wav_bytes(np.linspace(-1, 1, 16_000)))
    (tmp_path / "b.wav").write_bytes(b"no wave file")
    files = audio.wav_contents(spark, str(tmp_path))
    assert {r["audio"][-5:]: r["d"] for r in files.select("audio", audio.duration("content").alias("d")).collect()} == {"a.wav": 1.0, "b.wav": None}
    chunks = spark.createDataFrame([(f"{tmp_path}/a.wav", 0, 0.0, 0.25), (f"{tmp_path}/a.wav", 1, 0.5, 0.99)], "audio string, segment int, start_time double, end_time double")
    got = {r["segment"]: wav_duration(bytes(r["wav"])) for r in audio.cut_chunks(chunks, files).collect()}
    assert got == {0: pytest.approx(0.3), 1: pytest.approx(0.5)}


def test_matching_rows(spark):
    rows = spark.createDataFrame([(1, "in their day", "ɪn ðɛɹ deɪ"), (2, "in their day", "ɪn ðɛɹ"), (3, "in", "")], "id int, text string, said string")
    lex = spark.createDataFrame([("in", ["ɪ n", "ə n"]), ("their", ["ð ɛ ɹ"]), ("day", ["d eɪ"])], "word string, pronunciations array<string>")
    assert [r["id"] for r in keep_matching(rows, "id", "text", "said", lex).collect()] == [1]
    assert DictionaryG2P({"hi": "h aɪ"}).phonemes("Hi, yo") == ["h aɪ", ",", "y o"]


def test_streaming(spark, tmp_path):
    from cadenza.streaming.silence import streaming_segments

    rows = [("u", 0.0, 0.4, "2024-01-01 00:00:00"), ("u", 0.5, 0.8, "2024-01-01 00:00:00"), ("u", 2.0, 2.5, "2024-01-01 00:00:00"), ("z", 0.0, 1.0, "2024-02-01 00:00:00")]
    df = spark.createDataFrame(rows, "utt_id string, start_time double, end_time double, t string").withColumn("recorded_at", F.to_timestamp("t")).drop("t")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = streaming_segments(stream, 300, "1 minute").writeStream.format("memory").queryName("segments").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    got = sorted((r["utt_id"], r["n"], r["end_time"].microsecond // 1000) for r in spark.sql("select * from segments").collect())
    assert got == [("u", 1, 500), ("u", 2, 800)]


def test_command_line(spark, tmp_path):
    import argparse

    from cadenza.__main__ import build

    rows = [("u", i, "x", float(i), i + 0.5, i) for i in range(4)]
    spark.createDataFrame(rows, "utt_id string, pos bigint, text string, start_time double, end_time double, offset_id bigint").write.parquet(str(tmp_path / "o"))
    a = argparse.Namespace(command="segment", input=str(tmp_path / "o"), silence=0.6, minimum=0.2)
    assert [r["n"] for r in build(spark, a).collect()] == [4]
    a.command = "periods"
    assert build(spark, a).count() == 4


def test_ranks_and_sums_in_stretches(spark):
    import random

    from cadenza.operators.dataset import batches, best_of, speaker_splits, sums_before

    rng = random.Random(9)
    ids = rng.sample(range(300_000), 400)
    df = spark.createDataFrame([(i,) for i in ids], "row_id bigint")
    assert {r["row_id"]: r["batch"] for r in batches(df, "row_id", block=50).collect()} == {i: k // 10 for k, i in enumerate(sorted(ids))}
    sums = spark.createDataFrame([(i, i % 7) for i in sorted(ids)], "b bigint, n bigint")
    assert {r["b"]: r["x"] for r in sums_before(sums, "b", "n", "x", width=1000).collect()} == {i: sum(j % 7 for j in ids if j < i) for i in ids}
    people = [(f"s{k:03d}",) for k in range(200) for _ in range(1 + k % 3 // 2)] + [("big",)] * 40 + [(None,)]
    got = speaker_splits(spark.createDataFrame(people, "speaker string")).collect()
    counts = {}
    for (s,) in people:
        if s:
            counts[s] = counts.get(s, 0) + 1
    total, before, want = sum(counts.values()), 0, {}
    for s in sorted(counts, key=lambda s: (-counts[s], s)):
        want[s] = "train" if before < int(0.8 * total) else "test" if before < int(0.9 * total) else "validation"
        before += counts[s]
    assert {r["speaker"]: r["split"] for r in got} == want
    best = spark.createDataFrame([(1, [0.5, 2.0, 2.0]), (2, []), (3, None), (4, [None, -1.0])], "i int, v array<double>").select("i", best_of(F.col("v")).alias("b")).collect()
    assert {r["i"]: r["b"] and tuple(r["b"]) for r in best} == {1: (2.0, 1), 2: None, 3: None, 4: (-1.0, 1)}


def test_shared_folder_must_be_named_on_a_cluster(spark):
    from types import SimpleNamespace

    from cadenza.runtime import shared_dir

    conf = SimpleNamespace(get=lambda *a: None)
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            shared_dir(SimpleNamespace(sparkContext=SimpleNamespace(getConf=lambda: conf, getCheckpointDir=lambda: None, master=master), conf=conf))
    assert shared_dir(spark)


def test_folders_and_data_sets(spark, tmp_path):
    from cadenza.sources.storage import copy_folder, listing, read_dataset, subfolders, write_dataset

    (tmp_path / "a/b").mkdir(parents=True)
    (tmp_path / "a/x.txt").write_text("1")
    (tmp_path / "a/b/y.json").write_text("22")
    (tmp_path / "a/.hidden").write_text("3")
    assert {(r["path"].rsplit("/", 1)[1], r["length"]) for r in listing(spark, str(tmp_path / "a"), (".txt", ".json")).collect()} == {("x.txt", 1), ("y.json", 2)}
    assert subfolders(spark, str(tmp_path / "a")) == ["b"]
    assert copy_folder(spark, str(tmp_path / "a"), str(tmp_path / "c")) == 2 and (tmp_path / "c/b/y.json").read_text() == "22" and not (tmp_path / "c/.hidden").exists()
    df = spark.createDataFrame([(i,) for i in range(10)], "i int")
    write_dataset(df.filter("i < 7"), str(tmp_path), "d", "train", rows_per_file=3)
    write_dataset(df.filter("i >= 7"), str(tmp_path), "d", "test")
    assert read_dataset(spark, str(tmp_path), "d", "train").count() == 7
    assert {r["split"]: r["n"] for r in read_dataset(spark, str(tmp_path), "d").groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()} == {"train": 7, "test": 3}


def test_samples(spark):
    from cadenza.backends import resampled
    from cadenza.operators.audio import convert_audio, padded

    assert [r[0] for r in spark.createDataFrame([([1.0, 2.0, 3.0],), ([1.0],), ([],), (None,)], "x array<double>").select(padded(F.col("x"), 2)).collect()] == [[1.0, 2.0], [1.0, 0.0], [0.0, 0.0], None]
    wave = np.sin(np.arange(8000) / 40).astype(np.float32)
    half = resampled(wave, 16_000, 8_000)
    assert len(half) == 4000 and np.abs(half - wave[::2]).max() < 1e-3 and len(resampled(wave[:0], 16_000, 8_000)) == 0
    import shutil

    if shutil.which("ffmpeg") is None:
        with pytest.raises(RuntimeError):
            convert_audio(spark.createDataFrame([("a", "b")], "a string, b string"), "a", "b")
