"""Queries of the core, each a function of the session and the folder of the tables, with DuckDB SQL beside it."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .functions.paths import basename, language_of, parent, speaker_of, stem
from .functions.text import DIACRITICS, TAGS, aligner_form, fold, glued, greedy_log_probability, int16_pcm, phoneme_form, sigmoid, split_words, tokens, transcript_form
from .backends import classify
from .operators.audio import fixed_chunks as chunked
from .operators.audio import strided_chunks
from .operators.dataset import (
    batches, before_after, best_of, by_base_name, contained, keep_labelled, log_record, phonemes_match, preferred_text, same_words, speaker_splits, total_duration, with_partner, without_partner, without_prefixes,
)
from .operators.lexicon import long_lexicon, lookup, merge_lexicons, missing_words, pronunciation_counts, small
from .operators.metrics import equalised_lexicon, error_counts, error_rate, punctuated
from .operators.offsets import ORDER, blocked, clean_offsets, is_blank_token, joined_text, last_end, merge_on_delimiter, running_total, shift, to_nested, valid_recordings
from .operators.periods import continuous_periods, silences
from .operators.segment import label_tags, long_chunks, normalised_lexicon, phoneme_overlap_runs, segment_bounds, segment_manifest, silence_segments, tagged_segments, word_overlap_chunks
from .runtime import materialize, table
from .sources.readers import from_manifest, modified_since, parsed_lines, with_sidecar
from .sources.writers import flatten_manifest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its name, with its SQL if there is one."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


_PERIODS = """
WITH v AS (SELECT utt_id, CAST(round(start_time * 1000) AS BIGINT) AS s, CAST(round(end_time * 1000) AS BIGINT) AS e FROM utt_offsets
           WHERE utt_id IS NOT NULL AND start_time IS NOT NULL AND end_time IS NOT NULL),
w AS (SELECT *, max(e) OVER (PARTITION BY utt_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM v WHERE e > s),
x AS (SELECT utt_id, s, e, m, sum(CASE WHEN m IS NULL OR s > m THEN 1 ELSE 0 END) OVER (PARTITION BY utt_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS n FROM w),
p AS (SELECT utt_id, n, min(s) AS start_ms, max(e) AS end_ms FROM x GROUP BY utt_id, n),
q AS (SELECT utt_id, start_ms, end_ms, lead(start_ms) OVER (PARTITION BY utt_id ORDER BY n) AS next_start_ms FROM p)
"""


@query(_PERIODS + "SELECT utt_id, end_ms AS gap_start_ms, next_start_ms AS gap_end_ms FROM q WHERE next_start_ms - end_ms >= 1000")
def p3_found(spark, d):
    return silences(table(spark, d, "utt_offsets"))


@query(_PERIODS + "SELECT utt_id, start_ms, end_ms, next_start_ms, next_start_ms - end_ms AS gap_ms FROM q")
def p3_periods(spark, d):
    return continuous_periods(table(spark, d, "utt_offsets"))


# --- offsets and segments

_O = """o AS (SELECT utt_id, pos, text, start_time, end_time, min(offset_id) AS offset_id FROM utt_offsets
  WHERE utt_id IS NOT NULL AND pos IS NOT NULL AND start_time IS NOT NULL AND end_time IS NOT NULL GROUP BY ALL)"""
_W = "PARTITION BY utt_id ORDER BY pos, start_time, end_time, offset_id"


def _seg(gap: float) -> str:
    return f"""{_O}, g AS (SELECT *, lag(end_time) OVER ({_W}) AS prev FROM o),
s AS (SELECT *, CAST(sum(CASE WHEN prev IS NULL OR round(start_time - prev, 3) >= {gap} THEN 1 ELSE 0 END) OVER ({_W} ROWS UNBOUNDED PRECEDING) AS BIGINT) - 1 AS segment FROM g),
b AS (SELECT utt_id, segment, count(*) AS n, first(start_time ORDER BY pos, start_time, end_time, offset_id) AS start_time, last(end_time ORDER BY pos, start_time, end_time, offset_id) AS end_time
      FROM s GROUP BY utt_id, segment)"""


def _offsets(spark, d):
    return clean_offsets(table(spark, d, "utt_offsets"))


def _segments(spark, d, gap):
    return silence_segments(_offsets(spark, d), gap)


@query(f"WITH {_seg(0.3)} SELECT * FROM b")
def silence_bounds(spark, d):
    return segment_bounds(_segments(spark, d, 0.3))


@query(f"WITH {_seg(0.0)} SELECT * FROM b")
def silence_bounds_zero(spark, d):
    return segment_bounds(_segments(spark, d, 0.0))


@query(f"""WITH {_seg(0.3)}, f AS (SELECT *, first_value(start_time) OVER (PARTITION BY utt_id, segment ORDER BY pos, start_time, end_time, offset_id) AS z FROM s)
SELECT utt_id, segment, pos, offset_id, round(start_time - z, 3) AS start_time, round(end_time - z, 3) AS end_time FROM f""")
def segment_shift(spark, d):
    return shift(_segments(spark, d, 0.3), ["utt_id", "segment"]).select("utt_id", "segment", "pos", "offset_id", "start_time", "end_time")


@query(f"WITH {_seg(0.3)} SELECT utt_id, segment, n, round(end_time * 1000 + 50 - start_time * 1000, 3) AS chunk_ms FROM b WHERE round(end_time * 1000 + 50 - start_time * 1000, 3) >= 1000")
def chunk_index_with_holes(spark, d):
    return long_chunks(segment_bounds(_segments(spark, d, 0.3)), 1.0).select("utt_id", "segment", "n", "chunk_ms")


@query(f"""WITH {_seg(0.3)}, p AS (SELECT *, lag(segment) OVER ({_W}) AS pseg, lag(pos) OVER ({_W}) AS ppos FROM s)
SELECT utt_id, pos, text, start_time, end_time, segment, false AS is_tag FROM s
UNION ALL SELECT utt_id, ppos, '<EMPTY>', prev, start_time, segment, true FROM p WHERE pseg = segment AND round(start_time - prev, 3) >= 0.1""")
def gap_tags(spark, d):
    return tagged_segments(silence_segments(_offsets(spark, d), 0.3, previous=True), 0.1)


_LABELS = {"speech": 7, "music": 5, "noise": 3}


def _scores(tags):
    """Stands in for a noise model: scores made from a tag's times."""
    ms = F.round(F.col("start_time") * 1000).cast("bigint")
    each = F.array(*[F.struct(F.lit(n).alias("label"), (F.pmod(ms, F.lit(k)) / F.lit(float(k))).alias("score")) for n, k in _LABELS.items()])
    return tags.filter("is_tag").select("utt_id", "segment", "pos", F.explode(each).alias("x")).select("utt_id", "segment", "pos", "x.*").groupBy("utt_id", "segment", "pos", "label").agg(F.max("score").alias("score"))


@query(f"""WITH {_seg(0.3)}, p AS (SELECT *, lag(segment) OVER ({_W}) AS pseg, lag(pos) OVER ({_W}) AS ppos FROM s),
t AS (SELECT utt_id, ppos AS pos, segment, prev AS start_time FROM p WHERE pseg = segment AND round(start_time - prev, 3) >= 0.1),
k AS (SELECT utt_id, segment, pos, label, max(((CAST(round(start_time * 1000) AS BIGINT) % m) + m) % m / CAST(m AS DOUBLE)) AS score FROM t, (VALUES ('speech', 7), ('music', 5), ('noise', 3)) l(label, m) GROUP BY ALL),
w AS (SELECT utt_id, segment, pos, first(label ORDER BY score DESC, label) AS label FROM k WHERE score >= 0.5 GROUP BY ALL)
SELECT coalesce('<' || label || '>', '<EMPTY>') AS text, count(*) AS n FROM t LEFT JOIN w USING (utt_id, segment, pos) GROUP BY 1""")
def noise_labels(spark, d):
    tags = materialize(tagged_segments(silence_segments(_offsets(spark, d), 0.3, previous=True), 0.1).filter("is_tag"))
    return label_tags(tags, _scores(tags), 0.5).groupBy("text").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_seg(0.3)} SELECT utt_id, segment, string_agg(text, ' ' ORDER BY pos, start_time, end_time, offset_id) FILTER (text <> '') AS text FROM s GROUP BY ALL")
def segment_text(spark, d):
    item = F.struct("pos", "start_time", "end_time", "offset_id", "text")
    texts = _segments(spark, d, 0.3).groupBy("utt_id", "segment").agg(F.transform(F.sort_array(F.collect_list(F.when(F.col("text") != "", item))), lambda x: x["text"]).alias("t"))
    return texts.select("utt_id", "segment", F.when(F.size("t") > 0, F.array_join("t", " ")).alias("text"))


@query(f"""WITH {_O}, x AS (SELECT *, CASE WHEN text IS NULL OR NOT regexp_matches(text, '\\S') THEN 1 ELSE 0 END AS d FROM o),
y AS (SELECT *, sum(d) OVER ({_W} ROWS UNBOUNDED PRECEDING) AS g FROM x),
z AS (SELECT utt_id, g, first(start_time ORDER BY pos, start_time, end_time, offset_id) AS start_time, last(end_time ORDER BY pos, start_time, end_time, offset_id) AS end_time,
        string_agg(text, ' ' ORDER BY pos, start_time, end_time, offset_id) AS text, count(*) AS n FROM y WHERE d = 0 GROUP BY ALL)
SELECT utt_id, row_number() OVER (PARTITION BY utt_id ORDER BY g) - 1 AS word, start_time, end_time, text, n FROM z""")
def merged_sounds(spark, d):
    return merge_on_delimiter(_offsets(spark, d), F.col("text").isNull() | ~F.col("text").rlike(r"\S"))


_GT = r"""u AS (SELECT audio, id, lower(regexp_replace(ground_truth, '^\s+|\s+$', '', 'g')) AS g FROM utterances WHERE ground_truth <> ''),
gt AS (SELECT audio, id, w AS word, j - 1 AS j, n FROM (SELECT audio, id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS j, len(ws) AS n FROM (SELECT audio, id, list_filter(regexp_split_to_array(g, '\s+'), lambda x: x <> '') AS ws FROM u))),
oa AS (SELECT u.audio, o.* FROM o JOIN u ON u.id = o.utt_id)"""
_WA = "PARTITION BY audio ORDER BY pos, start_time, end_time, offset_id"


def _recordings(spark, d):
    """``(rec, audio, utt_id, ground_truth)`` of the recordings that have a truth, numbered: an id may have several paths, and a
    number is shorter to shuffle."""
    u = table(spark, d, "utterances").filter("ground_truth <> ''").select("audio", F.col("id").alias("utt_id"), "ground_truth")
    return materialize(u.withColumn("rec", F.monotonically_increasing_id()))


def _truths(u):
    """``(rec, j, m, word)``: the words of the truths."""
    return u.select("rec", split_words(fold(F.col("ground_truth"))).alias("ws")).select("rec", F.size("ws").alias("m"), F.posexplode("ws").alias("j", "word"))


def _heard(spark, d, u):
    """Offsets of the recordings ``u``, those of one id for each of its paths."""
    return clean_offsets(table(spark, d, "utt_offsets").join(u.select("rec", "utt_id"), "utt_id"), "rec")


@query(rf"""WITH {_O}, {_GT},
i AS (SELECT audio, row_number() OVER ({_WA}) - 1 AS i, lower(regexp_replace(text, '^\s+|\s+$', '', 'g')) AS word FROM oa),
m AS (SELECT DISTINCT i.audio, i FROM i JOIN gt ON i.audio = gt.audio AND i.word = gt.word AND i < n AND j >= i),
r AS (SELECT audio, i, i - row_number() OVER (PARTITION BY audio ORDER BY i) AS k FROM m)
SELECT audio, min(i) AS first_word, count(*) AS n FROM r GROUP BY audio, k""")
def truth_overlap(spark, d):
    """Long form of the overlap with the ground truth: words of the first ones that the truth has at their place or later."""
    u = _recordings(spark, d)
    i = running_total(blocked(_heard(spark, d, u)), F.lit(1), "i", "rec").select("rec", (F.col("i") - 1).alias("i"), fold(F.col("text")).alias("heard"), "start_time", "end_time")
    runs = phoneme_overlap_runs(i, _truths(u).withColumnRenamed("word", "heard"), "rec")
    return runs.join(u, "rec").select("audio", "first_word", "n")


@query(rf"""WITH {_O}, {_GT},
form AS (SELECT DISTINCT word, regexp_replace(translate(p, '{DIACRITICS}', ''), '^\s+|\s+$', '', 'g') AS variant, p FROM (SELECT word, unnest(pronunciations) AS p FROM lexicon) WHERE word IS NOT NULL AND p IS NOT NULL),
v AS (SELECT gt.audio, gt.j, gt.n, coalesce(form.variant, gt.word) AS variant FROM gt LEFT JOIN form ON form.word = gt.word),
said AS (SELECT word, min(p) AS p FROM form GROUP BY word),
x AS (SELECT oa.*, CASE WHEN oa.text = ' ' THEN [' '] ELSE list_filter(regexp_split_to_array(coalesce(said.p, lower(regexp_replace(oa.text, '^\s+|\s+$', '', 'g')), ''), '\s+'), lambda t: t <> '') || [' '] END AS sounds
      FROM oa LEFT JOIN said ON said.word = lower(regexp_replace(oa.text, '^\s+|\s+$', '', 'g'))),
y AS (SELECT audio, pos, start_time, end_time, offset_id, unnest(sounds) AS sound, unnest(range(0, len(sounds))) AS k FROM x),
z AS (SELECT *, count(*) FILTER (sound = ' ') OVER (PARTITION BY audio ORDER BY pos, start_time, end_time, offset_id, k ROWS UNBOUNDED PRECEDING) AS g FROM y),
w AS (SELECT audio, g, string_agg(sound, ' ' ORDER BY pos, start_time, end_time, offset_id, k) AS text, first(start_time ORDER BY pos, start_time, end_time, offset_id, k) AS start_time,
        last(end_time ORDER BY pos, start_time, end_time, offset_id, k) AS end_time FROM z WHERE sound <> ' ' GROUP BY ALL),
i AS (SELECT *, row_number() OVER (PARTITION BY audio ORDER BY g) - 1 AS i, regexp_replace(translate(text, '{DIACRITICS}', ''), '^\s+|\s+$', '', 'g') AS heard FROM w),
m AS (SELECT DISTINCT i.audio, i.i, i.start_time, i.end_time FROM i JOIN v ON v.audio = i.audio AND v.variant = i.heard AND i.i < v.n AND v.j >= i.i),
r AS (SELECT *, i - row_number() OVER (PARTITION BY audio ORDER BY i) AS k FROM m)
SELECT audio, min(i) AS first_word, count(*) AS n, first(start_time ORDER BY i) AS start_time, last(end_time ORDER BY i) AS end_time FROM r GROUP BY audio, k""")
def phoneme_overlap(spark, d):
    """Long form of the phoneme overlap. The tables hold words, so each is said first: its least pronunciation, or itself
    out of the lexicon; then words are matched with the truth's variants. As a word's sounds lie between single spaces, what
    merging them would give is the pronunciation; ``merged_sounds`` merges."""
    lex = table(spark, d, "lexicon")
    u = _recordings(spark, d)
    variants = lookup(_truths(u), normalised_lexicon(lex)).select("rec", "m", "j", F.explode("pronunciations").alias("heard"))
    said = long_lexicon(lex).groupBy("word").agg(F.min("pronunciation").alias("p")).select("word", F.array("p").alias("pronunciations"))
    o = lookup(_heard(spark, d, u).withColumn("word", fold(F.col("text"))), said, fallback=lambda w: F.coalesce(w, F.lit("")))
    sounds = F.array_join(split_words(F.get("pronunciations", F.lit(0))), " ")
    o = o.select("rec", *ORDER, phoneme_form(sounds).alias("heard"), sounds.alias("sounds")).filter("sounds <> ''").drop("sounds")
    # written, as the total is taken of blocks and of rows
    words = running_total(blocked(materialize(o)), F.lit(1), "i", "rec").select("rec", (F.col("i") - 1).alias("i"), "start_time", "end_time", "heard")
    return phoneme_overlap_runs(words, variants, "rec").join(u, "rec").select("audio", "first_word", "n", "start_time", "end_time")


@query()
def word_overlap(spark, d):
    """Sequence-matcher segments of recordings with a ground truth, each matched whole."""
    u = _recordings(spark, d)
    found = to_nested(_heard(spark, d, u), "rec").join(u.withColumn("truth", split_words(F.col("ground_truth"))), "rec").select("audio", F.posexplode(word_overlap_chunks(F.col("offsets"), F.col("truth"))).alias("segment", "s"))
    return found.select("audio", "segment", F.size("s").alias("n"), F.get("s", F.lit(0))["start_time"].alias("start_time"), joined_text(F.col("s")).alias("text"))


@query(f"""WITH {_seg(0.3)}
SELECT b.utt_id, b.segment, o.pos AS inner_pos, o.start_time AS inner_start FROM b
LEFT JOIN o ON o.utt_id = b.utt_id AND o.start_time >= b.start_time - 0.06 AND o.end_time <= b.end_time + 0.06""")
def interval_containment(spark, d):
    o = _offsets(spark, d)
    b = segment_bounds(silence_segments(o, 0.3)).select("utt_id", "segment", "start_time", "end_time")
    met = contained(b, o.select("utt_id", "start_time", "end_time", F.col("pos").cast("string").alias("text")), "utt_id", cell=30.0)
    return met.select("utt_id", "segment", F.col("inner_text").cast("bigint").alias("inner_pos"), "inner_start")


@query(f"WITH {_O} SELECT utt_id, last(end_time ORDER BY pos, start_time, end_time, offset_id) AS duration FROM o GROUP BY 1")
def last_end_duration(spark, d):
    return last_end(_offsets(spark, d))


@query(f"WITH {_O} SELECT utt_id, count(*) AS n, count(*) FILTER (text IS DISTINCT FROM ' ') AS kept FROM o GROUP BY 1")
def whitespace_tokens(spark, d):
    return _offsets(spark, d).groupBy("utt_id").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(~is_blank_token(F.col("text")), 1)).alias("kept"))


@query(f"""WITH {_O}, l AS (SELECT utt_id, last(end_time ORDER BY pos, start_time, end_time, offset_id) AS duration FROM o GROUP BY 1),
c AS (SELECT utt_id, unnest(range(0, CAST(ceil(round(duration * 16000) / 240000) AS BIGINT))) AS k, CAST(round(duration * 16000) AS BIGINT) AS n FROM l WHERE duration > 0)
SELECT utt_id, k, k * 240000 AS first_sample, least(n, (k + 1) * 240000) AS end_sample FROM c WHERE least(n, (k + 1) * 240000) - k * 240000 >= 400""")
def fixed_chunks(spark, d):
    l = last_end_duration(spark, d).withColumn("n", F.round(F.col("duration") * 16000).cast("bigint"))
    return chunked(l, "n", 240_000).select("utt_id", "k", "first_sample", "end_sample")


@query(r"""WITH n AS (SELECT audio, CAST(strlen(ground_truth) * 3000 AS BIGINT) AS n FROM utterances), k AS (SELECT audio, n, a FROM (SELECT audio, n, unnest(range(0, n, 160000)) AS a FROM n))
SELECT audio, a AS first, least(a + 240000, n) AS "end", CASE WHEN a = 0 THEN 0 ELSE 40000 END AS "left", CASE WHEN a + 240000 > n THEN 0 ELSE 40000 END AS "right" FROM k
WHERE (a = 0 OR a - 160000 + 240000 <= n) AND least(a + 240000, n) - a > CASE WHEN a = 0 THEN 0 ELSE 40000 END""")
def strided_plan(spark, d):
    """Overlapping chunks for recognition; the length of the truth stands in for that of the audio."""
    u = table(spark, d, "utterances").select("audio", F.explode(strided_chunks(F.octet_length("ground_truth").cast("bigint") * 3000, 240_000)).alias("c"))
    return u.select("audio", "c.first", "c.end", "c.left", "c.right")


# --- text


def _sql_transcript(c: str) -> str:
    e = "'^\\s+|\\s+$', '', 'g'"
    x = f"regexp_replace(regexp_replace(regexp_replace(lower(regexp_replace({c}, '[,?.!\\-;:\"]', ' ', 'g')), {e}), '\\s+', ' ', 'g'), {e})"
    for t in TAGS:
        x = f"regexp_replace(replace({x}, '{t}', ''), {e})"
    return x


@query(f"SELECT row_id, md5({_sql_transcript('text')}) AS form FROM manifest")
def transcript_forms(spark, d):
    return table(spark, d, "manifest").select("row_id", F.md5(transcript_form(F.col("text"))).alias("form"))


@query(r"""SELECT row_id, array_to_string(list_filter(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+(?:[''’-][\p{L}\p{N}_]+)*|\.{2,}|[^\s\p{L}\p{N}_]+'), lambda t: NOT contains('!"#$%&''()*+,-./:;<=>?@[\]^_`{|}~', t)), ' ') AS words FROM manifest""")
def word_tokens(spark, d):
    return table(spark, d, "manifest").select("row_id", F.when(F.col("text").isNotNull(), F.array_join(tokens(F.col("text")), " ")).alias("words"))


_WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F)).replace("＇", "")


_BLANKS = "".join(chr(c) for c in range(0x80, 0x3001) if unicodedata.category(chr(c)) == "Zs")
_NARROW = "".join(chr(ord(c) - 0xFEE0) for c in _WIDE) + " " * len(_BLANKS)


@query(rf"""SELECT row_id, regexp_replace(regexp_replace(lower(strip_accents(nfc_normalize(translate(text, '{_WIDE}{_BLANKS}', '{_NARROW}')))), '[!-/:-@\[-`{{-~]', '', 'g'), '\s+', ' ', 'g') AS form FROM manifest""")
def aligner_forms(spark, d):
    return table(spark, d, "manifest").select("row_id", aligner_form(F.col("text")).alias("form"))


@query(f"SELECT DISTINCT word, p AS pronunciation, regexp_replace(translate(p, '{DIACRITICS}', ''), '^\\s+|\\s+$', '', 'g') AS form FROM (SELECT word, unnest(pronunciations) AS p FROM lexicon) WHERE p IS NOT NULL AND word IS NOT NULL")
def phoneme_forms(spark, d):
    return long_lexicon(table(spark, d, "lexicon")).select("word", "pronunciation", phoneme_form(F.col("pronunciation")).alias("form"))


@query(r"""SELECT row_id, audio, regexp_extract(audio, '([^/]*)$', 1) AS name, regexp_replace(regexp_extract(audio, '([^/]*)$', 1), '(.)\.[^.]*$', '\1') AS stem,
regexp_extract(audio, '([^/]*)/[^/]*$', 1) AS parent, split_part(regexp_extract(audio, '([^/]*)/[^/]*$', 1), '-', 1) AS lang, split_part(regexp_replace(regexp_extract(audio, '([^/]*)$', 1), '(.)\.[^.]*$', '\1'), '_', 1) AS who FROM manifest""")
def path_parts(spark, d):
    a = F.col("audio")
    return table(spark, d, "manifest").select("row_id", "audio", basename(a).alias("name"), stem(a).alias("stem"), parent(a).alias("parent"), language_of(parent(a)).alias("lang"), speaker_of(a).alias("who"))


@query(r"""SELECT row_id, coalesce(id, regexp_replace(regexp_extract(audio, '([^/]*)$', 1), '(.)\.[^.]*$', '\1')) AS id, coalesce(accent, language, regexp_extract(audio, '([^/]*)/[^/]*$', 1)) AS language_code,
coalesce(language, split_part(regexp_extract(audio, '([^/]*)/[^/]*$', 1), '-', 1)) AS language, text AS ground_truth FROM manifest WHERE audio <> '' AND coalesce(text, '') <> ''""")
def utterance_table(spark, d):
    return from_manifest(table(spark, d, "manifest")).select("row_id", "id", "language_code", "language", "ground_truth")


# --- lexicon

@query("""WITH l AS (SELECT DISTINCT language = 'en' AS en, word, p FROM (SELECT language, word, unnest(pronunciations) AS p FROM lexicon) WHERE word IS NOT NULL AND p IS NOT NULL)
SELECT word, string_agg(p, '|' ORDER BY p) AS pronunciations FROM (SELECT DISTINCT word, p FROM l) GROUP BY word""")
def lexicon_merge(spark, d):
    lex = table(spark, d, "lexicon")
    return merge_lexicons(lex.filter("language = 'en'"), lex.filter("language is null or language <> 'en'")).select("word", F.array_join("pronunciations", "|").alias("pronunciations"))


def _truth_words(spark, d):
    u = table(spark, d, "utterances").filter("ground_truth <> ''")
    return u.select(F.explode(split_words(F.lower("ground_truth"))).alias("word"))


_SQL_WORDS = r"w AS (SELECT unnest(list_filter(regexp_split_to_array(lower(ground_truth), '\s+'), lambda x: x <> '')) AS word FROM utterances WHERE ground_truth <> '')"
_SQL_LEX = "x AS (SELECT DISTINCT word, p FROM (SELECT word, unnest(pronunciations) AS p FROM lexicon) WHERE word IS NOT NULL AND p IS NOT NULL), l AS (SELECT word, string_agg(p, '|' ORDER BY p) AS ps FROM x GROUP BY word)"


@query(f"WITH {_SQL_WORDS}, {_SQL_LEX}, c AS (SELECT word, count(*) AS n FROM w GROUP BY 1) SELECT word, n, ps IS NOT NULL AS known, coalesce(ps, word) AS pronunciations FROM c LEFT JOIN l USING (word)")
def lexicon_lookup(spark, d):
    words = _truth_words(spark, d).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return lookup(words, merge_lexicons(table(spark, d, "lexicon"))).select("word", "n", "known", F.array_join("pronunciations", "|").alias("pronunciations"))


@query(f"WITH {_SQL_WORDS}, {_SQL_LEX} SELECT DISTINCT word FROM w WHERE word NOT IN (SELECT word FROM l)")
def missing_from_lexicon(spark, d):
    return missing_words(_truth_words(spark, d), merge_lexicons(table(spark, d, "lexicon")))


@query(r"SELECT word, phoneme, count(*) AS n FROM (SELECT word, unnest(list_filter(regexp_split_to_array(p, '\s+'), lambda x: x <> '')) AS phoneme FROM (SELECT DISTINCT word, p FROM (SELECT word, unnest(pronunciations) AS p FROM lexicon) WHERE word IS NOT NULL AND p IS NOT NULL)) GROUP BY ALL")
def phoneme_counts(spark, d):
    return pronunciation_counts(long_lexicon(table(spark, d, "lexicon")).select("word", F.explode(split_words(F.col("pronunciation"))).alias("phoneme")))


def _per_counts(spark, d):
    """The phonemes of each recognised word against the variants of the truth's word at its place, both in the lexicon."""
    lex = table(spark, d, "lexicon")
    said = long_lexicon(lex).groupBy("word").agg(split_words(F.min("pronunciation")).alias("said")).withColumnRenamed("word", "heard")
    u = _recordings(spark, d)
    i = running_total(blocked(_heard(spark, d, u).filter("text <> ' '")), F.lit(1), "i", "rec").select("rec", (F.col("i") - 1).alias("j"), fold(F.col("text")).alias("heard"))
    rows = i.join(_truths(u).select("rec", "j", "word"), ["rec", "j"]).join(small(said), "heard").join(small(equalised_lexicon(lex)), "word")
    return error_counts(rows.withColumn("stack", F.array("variants")), "stack", "said")


@query()
def per_micro(spark, d):
    return error_rate(_per_counts(spark, d))


@query()
def per_by_word(spark, d):
    return error_rate(_per_counts(spark, d), ["word"])


@query()
def punctuation_alignment(spark, d):
    """Three neighbouring lexicon words as a sentence of three parts, its sounds aligned with it."""
    lex = long_lexicon(table(spark, d, "lexicon")).groupBy("word").agg(F.min("pronunciation").alias("p"))
    by = W.partitionBy("k").orderBy("word")
    w = lex.withColumn("k", F.substring("word", 1, 2)).select("word", "p", F.lead("p").over(by).alias("q"), F.lead("p", 2).over(by).alias("r")).filter("r is not null")
    sounds = split_words(F.concat_ws(" ", "p", "q", "r"))
    rows = w.select("word", F.transform(sounds, lambda x, i: F.struct(x.alias("text"), (i * F.lit(0.1)).alias("start_time"), (i * F.lit(0.1) + F.lit(0.05)).alias("end_time"))).alias("o"), split_words(F.concat("p", F.lit(" , "), "q", F.lit(" ; "), "r", F.lit(" ."))).alias("t"))
    return rows.select("word", joined_text(punctuated(F.col("o"), F.col("t"))).alias("text"))


# --- data set

@query("SELECT u.audio, u.id, coalesce(t.text, '') AS text FROM utterances u LEFT JOIN (SELECT audio, last(text ORDER BY row_id) AS text FROM manifest WHERE audio IS NOT NULL GROUP BY audio) t ON t.audio = u.audio")
def sidecar_text(spark, d):
    side = table(spark, d, "manifest").filter("audio is not null").groupBy("audio").agg(F.max_by("text", "row_id").alias("text"))
    return with_sidecar(table(spark, d, "utterances").select("audio", "id"), side.withColumnRenamed("audio", "path"))


@query("SELECT lang, count(*) AS n, CAST(sum(strlen(text)) AS BIGINT) AS bytes FROM documents WHERE kind = 'dialogue' GROUP BY lang")
def category_filter(spark, d):
    """Rows by their best label; a classifier that reads the kind out of the path stands in for a model."""
    docs = table(spark, d, "documents").withColumn("audio", F.concat("kind", F.lit("/"), "doc_id"))
    kept = keep_labelled(docs, classify(docs, _KindClassifier), "audio", "dialogue")
    return kept.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).cast("bigint").alias("bytes"))


class _KindClassifier:
    def scores(self, audio):
        return [(audio.partition("/")[0], 0.9), ("other", 0.1)]


@query("SELECT row_id, audio FROM manifest WHERE id IN (SELECT id FROM utterances)")
def with_transcript(spark, d):
    return with_partner(table(spark, d, "manifest"), table(spark, d, "utterances"), "id").select("row_id", "audio")


@query("SELECT audio, id FROM utterances u WHERE NOT EXISTS (SELECT 1 FROM manifest m WHERE m.audio = u.audio)")
def not_yet_downloaded(spark, d):
    return without_partner(table(spark, d, "utterances"), table(spark, d, "manifest"), on="audio").select("audio", "id")


@query(f"WITH {_O}, l AS (SELECT utt_id, last(end_time ORDER BY pos, start_time, end_time, offset_id) AS x FROM o GROUP BY 1), u AS (SELECT id, min(language) AS language FROM utterances GROUP BY 1) SELECT language, round(sum(x), 3) AS duration FROM u JOIN l ON id = utt_id GROUP BY 1")
def duration_by_language(spark, d):
    u = table(spark, d, "utterances").groupBy("id").agg(F.min("language").alias("language"))
    return total_duration(u.join(last_end_duration(spark, d).withColumnRenamed("utt_id", "id"), "id"), "language", F.col("duration"))


@query(f"""WITH {_O}, l AS (SELECT utt_id, last(end_time ORDER BY pos, start_time, end_time, offset_id) AS x FROM o GROUP BY 1), u AS (SELECT id, min(lower(language_code)) AS c FROM utterances WHERE language_code IS NOT NULL GROUP BY 1)
SELECT '2024-01-01' AS date, 'training' AS label, split_part(c, '-', 1) AS language, c AS language_code, round(sum(x), 3) AS duration FROM u JOIN l ON id = utt_id GROUP BY c""")
def duration_log(spark, d):
    u = table(spark, d, "utterances").filter("language_code is not null").groupBy("id").agg(F.min(F.lower("language_code")).alias("code"))
    sums = total_duration(u.join(last_end_duration(spark, d).withColumnRenamed("utt_id", "id"), "id"), "code", F.col("duration"))
    r = sums.select(log_record("2024-01-01", "training", F.col("code"), F.col("duration")).alias("r"))
    return r.select("r.fields.date", "r.fields.label", "r.fields.language", F.col("r.fields.language-code").alias("language_code"), "r.fields.duration")


@query("""WITH c AS (SELECT speaker, count(*) AS n FROM manifest WHERE speaker IS NOT NULL GROUP BY 1),
b AS (SELECT *, coalesce(sum(n) OVER (ORDER BY n DESC, speaker ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(n) OVER () AS t FROM c)
SELECT speaker, n, CASE WHEN before < floor((1 - 0.1::DOUBLE - 0.1::DOUBLE) * t::DOUBLE) THEN 'train' WHEN before < floor((1 - 0.1::DOUBLE) * t::DOUBLE) THEN 'test' ELSE 'validation' END AS split FROM b""")
def speaker_split(spark, d):
    return speaker_splits(table(spark, d, "manifest"))


@query("SELECT speaker, count(*) AS n FROM manifest GROUP BY 1")
def rows_per_speaker(spark, d):
    return table(spark, d, "manifest").groupBy("speaker").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT language, count(*) AS n, count(*) FILTER (text NOT LIKE 'k%' AND text NOT LIKE 'm%') AS kept, round(sum(CAST(length(text) AS DOUBLE)) / 16000 / 3600, 6) AS hours FROM manifest GROUP BY 1")
def stats_before_after(spark, d):
    return before_after(table(spark, d, "manifest"), without_prefixes(F.col("text"), ("k", "m")), "language", F.char_length("text"))


@query(r"SELECT DISTINCT m.row_id, m.id FROM manifest m JOIN utterances u ON m.id = u.id WHERE array_to_string(list_filter(regexp_split_to_array(regexp_replace(lower(m.text), '[.,?!;:]', '', 'g'), '\s+'), lambda x: x <> ''), ' ') = u.ground_truth")
def label_agreement(spark, d):
    label = split_words(F.regexp_replace(F.lower("text"), "[.,?!;:]", ""))
    m = table(spark, d, "manifest").select("row_id", "id", label.alias("label"))
    return m.join(table(spark, d, "utterances").select("id", "ground_truth"), "id").filter(same_words(F.col("label"), F.col("ground_truth"))).select("row_id", "id").distinct()


@query(rf"""WITH {_O}, {_GT}, form AS (SELECT word, list(DISTINCT replace(p, ' ', '')) AS v, replace(min(p), ' ', '') AS said FROM (SELECT word, unnest(pronunciations) AS p FROM lexicon) WHERE word IS NOT NULL AND p IS NOT NULL GROUP BY word),
h AS (SELECT audio, row_number() OVER ({_WA}) - 1 AS j, coalesce(f.said, t) AS said FROM (SELECT *, lower(regexp_replace(text, '^\s+|\s+$', '', 'g')) AS t FROM oa WHERE text <> ' ' AND regexp_matches(text, '\S')) LEFT JOIN form f ON f.word = t),
t AS (SELECT audio, j, coalesce(v, [replace(gt.word, ' ', '')]) AS v FROM gt LEFT JOIN form f ON f.word = gt.word),
n AS (SELECT audio, count(*) AS n FROM h GROUP BY 1)
SELECT t.audio, bool_and(coalesce(list_contains(t.v, h.said), false)) AND count(*) = any_value(n.n) AS same FROM t LEFT JOIN h USING (audio, j) JOIN n USING (audio) GROUP BY t.audio""")
def phoneme_match(spark, d):
    """Whether a recording says its truth: as many words, each among the variants of its place. Recordings are of ordinary length,
    as they have a truth, and one row each."""
    lex = merge_lexicons(table(spark, d, "lexicon"))
    said = lex.select(F.col("word").alias("t"), glued(F.array_min("pronunciations")).alias("p"))
    u = _recordings(spark, d)
    o = _heard(spark, d, u).filter("text <> ' '").withColumn("t", fold(F.col("text"))).filter("t <> ''").join(small(said), "t", "left")
    h = o.groupBy("rec").agg(F.transform(F.sort_array(F.collect_list(F.struct(*ORDER, F.coalesce("p", "t").alias("s")))), lambda x: x["s"]).alias("said"))
    v = lookup(_truths(u), lex).groupBy("rec").agg(F.transform(F.array_sort(F.collect_list(F.struct("j", "pronunciations"))), lambda x: x["pronunciations"]).alias("v"))
    return h.join(v, "rec").join(u, "rec").select("audio", phonemes_match(F.col("said"), F.col("v")).alias("same"))


@query("SELECT vec_id, max(s) AS score, first(k ORDER BY s DESC, k) AS label FROM (SELECT vec_id, unnest(embedding) AS s, unnest(range(0, len(embedding))) AS k FROM embeddings) GROUP BY vec_id")
def argmax_label(spark, d):
    return table(spark, d, "embeddings").select("vec_id", best_of(F.col("embedding")).alias("b")).filter("b is not null").select("vec_id", "b.score", "b.label")


@query("SELECT vec_id, count(*) AS n, min(k) AS first_label FROM (SELECT vec_id, unnest(embedding) AS s, unnest(range(0, len(embedding))) AS k FROM embeddings) WHERE 1 / (1 + exp(-CAST(s AS DOUBLE))) >= 0.55 GROUP BY vec_id")
def multilabel_threshold(spark, d):
    kept = F.filter(F.transform("embedding", lambda x, i: F.struct(i.cast("bigint").alias("label"), sigmoid(x.cast("double")).alias("score"))), lambda s: s["score"] >= 0.55)
    rows = table(spark, d, "embeddings").select("vec_id", kept.alias("k")).filter(F.size("k") > 0)
    return rows.select("vec_id", F.size("k").cast("bigint").alias("n"), F.get("k", F.lit(0))["label"].alias("first_label"))


@query("""WITH f AS (SELECT vec_id, k // 8 AS frame, CAST(x AS DOUBLE) AS x FROM (SELECT vec_id, unnest(embedding) AS x, unnest(range(0, len(embedding))) AS k FROM embeddings)),
g AS (SELECT vec_id, frame, max(x) AS m FROM f GROUP BY ALL), h AS (SELECT vec_id, frame, -ln(sum(exp(x - m))) AS lp FROM f JOIN g USING (vec_id, frame) GROUP BY ALL)
SELECT vec_id, round(sum(lp), 6) AS greedy FROM h GROUP BY vec_id HAVING sum(lp) / count(*) > -2""")
def greedy_score(spark, d):
    frames = F.transform(F.sequence(F.lit(0), F.floor((F.size("embedding") - 1) / 8).cast("int")), lambda k: F.slice("embedding", k * 8 + 1, F.lit(8)))
    e = table(spark, d, "embeddings").select("vec_id", frames.alias("f")).withColumn("g", greedy_log_probability(F.col("f")))
    return e.filter(F.col("g") / F.size("f") > -2).select("vec_id", F.round("g", 6).alias("greedy"))


@query("SELECT vec_id, k, CAST(trunc(CAST(x * CAST(32767 AS DOUBLE) AS DOUBLE)) AS BIGINT) AS pcm FROM (SELECT vec_id, greatest(-1.0, least(1.0, CAST(unnest(embedding) AS DOUBLE))) AS x, unnest(range(0, len(embedding))) AS k FROM embeddings)")
def pcm_samples(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", F.posexplode("embedding").alias("k", "x"))
    return e.select("vec_id", F.col("k").cast("bigint").alias("k"), F.get(int16_pcm(F.array(F.col("x").cast("double"))), F.lit(0)).cast("bigint").alias("pcm"))


@query("SELECT row_id, audio FROM manifest WHERE modified_at > TIMESTAMP '2024-06-01 00:00:00'")
def modified_after(spark, d):
    return modified_since(table(spark, d, "manifest").withColumnRenamed("modified_at", "modified"), "2024-06-01 00:00:00").select("row_id", "audio")


@query("SELECT row_id, (row_number() OVER (ORDER BY row_id) - 1) // 10 AS batch FROM manifest")
def batch_of_ten(spark, d):
    return batches(table(spark, d, "manifest").select("row_id"), "row_id")


@query("SELECT split, count(*) AS n FROM (SELECT split, text FROM manifest UNION ALL SELECT split, text FROM eval_items) GROUP BY split")
def append_union(spark, d):
    return table(spark, d, "manifest").select("split", "text").unionByName(table(spark, d, "eval_items").select("split", "text")).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT audio FROM utterances ORDER BY audio LIMIT 100")
def first_paths(spark, d):
    return table(spark, d, "utterances").select("audio").orderBy("audio").limit(100)


@query(rf"""WITH {_seg(0.3)}, u AS (SELECT id, min(audio) AS audio, min_by(ground_truth, audio) AS text FROM utterances GROUP BY id),
c AS (SELECT * FROM b JOIN u ON utt_id = id WHERE round(end_time * 1000 + 50 - start_time * 1000, 3) >= 200),
e AS (SELECT 'out/' || regexp_extract(audio, '([^/]*)/[^/]*$', 1) || '/' || regexp_replace(regexp_extract(audio, '([^/]*)$', 1), '(.)\.[^.]*$', '\1') || '-' || segment AS stem, text FROM c)
SELECT stem || '.wav' AS wav_path, stem || '.tsv' AS tsv_path, text FROM e""")
def chunk_manifest(spark, d):
    u = table(spark, d, "utterances").groupBy("id").agg(F.min("audio").alias("audio"), F.min_by("ground_truth", "audio").alias("transcript")).withColumnRenamed("id", "utt_id")
    return segment_manifest(long_chunks(segment_bounds(_segments(spark, d, 0.3)), 0.2).join(u, "utt_id"), "audio", "out", "transcript")


@query("SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS k FROM events GROUP BY 1")
def json_fields(spark, d):
    rows = parsed_lines(table(spark, d, "events"), "k bigint", "props", ("event_type",))
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("k"))


@query(f"WITH {_O} SELECT utt_id, bool_and(text IS NOT NULL AND start_time IS NOT NULL AND end_time IS NOT NULL) AS valid, count(*) AS n FROM utt_offsets WHERE utt_id IS NOT NULL GROUP BY 1")
def valid_offsets(spark, d):
    return valid_recordings(table(spark, d, "utt_offsets"))


@query(f"""WITH {_seg(0.3)}, c AS (SELECT utt_id, list({{'segment': segment, 'n': n}} ORDER BY segment) AS x FROM b GROUP BY 1)
SELECT utt_id, y.segment AS segment, y.n AS n FROM (SELECT utt_id, unnest(x) AS y FROM c)""")
def manifest_flatten(spark, d):
    """Segments of a recording nested in one manifest row, and flattened again with null entries gone."""
    b = segment_bounds(_segments(spark, d, 0.3)).select("utt_id", F.struct("utt_id", "segment", "n").alias("x"))
    nested = b.groupBy("utt_id").agg(F.concat(F.collect_list("x"), F.array(F.lit(None).cast("struct<utt_id:string,segment:bigint,n:bigint>"))).alias("rows"))
    return flatten_manifest(nested, "rows")


@query(rf"""WITH m AS (SELECT regexp_replace(regexp_extract(audio, '([^/]*)$', 1), '(.)\.[^.]*$', '\1') AS stem, audio, text FROM manifest WHERE audio IS NOT NULL),
x AS (SELECT stem, arg_max(audio, audio) AS audio FROM m GROUP BY stem) SELECT u.audio, x.audio AS aligned FROM utterances u LEFT JOIN x ON x.stem = regexp_replace(regexp_extract(u.audio, '([^/]*)$', 1), '(.)\.[^.]*$', '\1')""")
def aligned_by_name(spark, d):
    """Recordings with the alignment of the same base name; a manifest's paths stand in for alignments."""
    m = table(spark, d, "manifest").filter("audio is not null").select("audio", F.array(F.struct(F.col("audio").alias("text"), F.lit(0.0).alias("start_time"), F.lit(0.0).alias("end_time"))).alias("offsets"))
    return by_base_name(table(spark, d, "utterances").select("audio"), m).select("audio", F.get("offsets", F.lit(0))["text"].alias("aligned"))


@query("""WITH j AS (SELECT id, max(text) AS t FROM manifest WHERE split = 'test' GROUP BY id), x AS (SELECT id, max(text) AS t FROM manifest WHERE split = 'train' GROUP BY id)
SELECT u.audio, coalesce(j.t, x.t) AS text FROM utterances u LEFT JOIN j USING (id) LEFT JOIN x USING (id)""")
def preferred_transcript(spark, d):
    """The first of two sources of transcripts that has one; splits of the manifest stand in for the sources."""
    m = table(spark, d, "manifest")
    return preferred_text(table(spark, d, "utterances").select("audio", "id"), "id", m.filter("split = 'test'"), m.filter("split = 'train'")).select("audio", "text")
