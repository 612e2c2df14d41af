"""Sources: audio folders, manifests, offsets, transcripts and alignments, each with an explicit schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.paths import language_of, parent, stem, with_suffix


def audio_files(spark: SparkSession, path: str, extension: str = "wav", recursive: bool = True) -> DataFrame:
    """``(audio, length, modified)`` of the non-empty files; contents aren't read. No file is an error."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{extension}").option("recursiveFileLookup", str(recursive).lower()).load(path)
    files = files.select(F.regexp_replace("path", "^file:/+", "/").alias("audio"), "length", F.col("modificationTime").alias("modified")).filter("length > 0")
    if files.limit(1).count() == 0:
        raise ValueError(f"no {extension} file with content in {path}")
    return files


def modified_since(files: DataFrame, when: str) -> DataFrame:
    """Files changed after, and not at, ``when``; a date that can't be read filters nothing."""
    t = F.try_to_timestamp(F.lit(when))
    return files.filter(t.isNull() | (F.col("modified") > t))


def text_files(spark: SparkSession, path: str, extension: str = "txt") -> DataFrame:
    """``(path, text)`` of whole files."""
    t = spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*.{extension}").text(path)
    return t.select(F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "/").alias("path"), F.col("value").alias("text"))


def with_sidecar(df: DataFrame, texts: DataFrame, path: str = "audio") -> DataFrame:
    """``df`` with ``text`` of ``texts`` ``(path, text)``, the text beside each file; empty where there is none."""
    side = texts.select(F.col("path").alias(path), F.col("text").alias("__text"))
    return df.join(side, path, "left").withColumn("text", F.coalesce("__text", F.lit(""))).drop("__text")


def utterances_from_folder(spark: SparkSession, path: str, extension: str = "wav") -> DataFrame:
    """The utterance table of a folder ``{lang-region}/{speaker}_{utt}``: texts from ``.txt`` files beside the audio;
    utterances without one are left out."""
    a = F.col("audio")
    texts = text_files(spark, path).select(with_suffix(F.col("path"), f".{extension}").alias("path"), F.trim("text").alias("text"))
    joined = with_sidecar(audio_files(spark, path, extension).select("audio"), texts)
    return joined.filter("text <> ''").select("audio", stem(a).alias("id"), parent(a).alias("language_code"), language_of(parent(a)).alias("language"), F.col("text").alias("ground_truth"))


def audio_with_text(spark: SparkSession, path: str, extension: str = "mp3") -> DataFrame:
    """``(audio, text)`` of the files that have a ``.txt`` file of the same name beside them."""
    texts = text_files(spark, path).select(with_suffix(F.col("path"), f".{extension}").alias("audio"), "text")
    return audio_files(spark, path, extension).select("audio").join(texts, "audio")


def language_folders(files: DataFrame, languages: tuple[str, ...], without: str = "practiceError", path: str = "audio") -> DataFrame:
    """Files in folders whose name starts with one of the languages; paths that hold ``without`` are left out."""
    wanted = F.lit(False)
    for x in languages:
        wanted = wanted | parent(F.col(path)).startswith(x)
    return files.filter(wanted & ~F.col(path).contains(without))


def from_manifest(m: DataFrame) -> DataFrame:
    """The utterance table of input manifest rows, further columns kept: the id falls back to the file's stem, the
    language code from accent to language to folder, the language to the folder's prefix. Missing and null count
    alike. Rows without audio or with an empty text are left out."""
    a = F.col("audio")
    folder = parent(a)
    named = m.filter((F.coalesce(a, F.lit("")) != "") & (F.coalesce("text", F.lit("")) != ""))
    return named.withColumns(
        {
            "id": F.coalesce("id", stem(a)),
            "language_code": F.coalesce("accent", "language", folder),
            "language": F.coalesce("language", language_of(folder)),
            "ground_truth": F.col("text"),
        }
    )


def utterances_from_manifest(spark: SparkSession, path: str, files: DataFrame | None = None) -> DataFrame:
    """The utterance table of a JSON-array manifest; bad JSON or no usable row is an error. With ``files``, a listing with ``audio``
    and ``length``, rows whose file is missing or empty are left out."""
    raw = spark.read.schema(schemas.INPUT_MANIFEST).option("multiLine", "true").option("mode", "FAILFAST").json(path)
    try:
        out = from_manifest(raw).select("audio", "id", "language_code", "language", "ground_truth")
        if files is not None:
            out = out.join(files.filter("length > 0").select("audio"), "audio", "left_semi")
        empty = out.limit(1).count() == 0
    except Exception as e:  # the reader fails when it runs
        raise ValueError(f"can't read {path} as JSON") from e
    if empty:
        raise ValueError(f"no usable row in {path}")
    return out


def parsed_lines(lines: DataFrame, schema: str, column: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows of JSON texts in ``column``, and the columns of ``keep``; blank, empty and broken ones are left out."""
    parsed = lines.filter(F.trim(column) != "").select(*keep, F.from_json(column, schema, {"mode": "PERMISSIVE"}).alias("__r"))
    some = F.lit(False)
    for f in parsed.schema["__r"].dataType.fields:
        some = some | F.col(f"__r.{f.name}").isNotNull()
    return parsed.filter(some).select(*keep, "__r.*")


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a JSON-lines file, as :func:`parsed_lines`; a missing file gives none."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return parsed_lines(spark.createDataFrame([], "value string"), schema)
    return parsed_lines(spark.read.text(path), schema)


def aligner_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Rows of an aligner's output manifest that name a CTM file: ``(audio, text, ctm)``."""
    m = json_lines(spark, path, schemas.ALIGNER_MANIFEST)
    return m.filter("audio_filepath is not null and words_level_ctm_filepath is not null").select(F.col("audio_filepath").alias("audio"), "text", F.col("words_level_ctm_filepath").alias("ctm"))


def aligned_offsets(spark: SparkSession, manifest: str, ctm_folder: str) -> DataFrame:
    """``(audio, offsets)`` of an aligner's output: the CTM files below ``ctm_folder`` that its manifest names, in the order of their
    lines' times."""
    words = ctm(spark, ctm_folder, True)
    item = F.struct("start_time", "end_time", "text")
    grouped = words.groupBy("path").agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: F.struct(x["text"].alias("text"), x["start_time"].alias("start_time"), x["end_time"].alias("end_time"))).alias("offsets"))
    listed = aligner_manifest(spark, manifest)
    return listed.join(grouped, F.regexp_replace(listed.ctm, "^file:/+", "/") == grouped.path).select("audio", "offsets")


def json_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """``(word, pronunciations)`` of a JSON object of words to lists of pronunciations."""
    return spark.read.option("wholetext", "true").text(path).select(F.explode(F.from_json("value", "map<string,array<string>>")).alias("word", "pronunciations"))


def valid(offsets: Column) -> Column:
    """Whether nested offsets are there and each has text and times."""
    return (F.size(offsets) > 0) & F.forall(offsets, lambda o: o["text"].isNotNull() & o["start_time"].isNotNull() & o["end_time"].isNotNull())


def offsets_json(spark: SparkSession, path: str) -> DataFrame:
    """``(path, offsets)`` of per-utterance JSON arrays; invalid ones are left out."""
    raw = text_files(spark, path, "json")
    return raw.select("path", F.from_json("text", schemas.OFFSETS).alias("offsets")).filter(valid(F.col("offsets")))


def transcript_tsv(spark: SparkSession, path: str) -> DataFrame:
    """``(path, pos, start_time, end_time, label)`` of TSV files without header."""
    t = spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.tsv").text(path)
    lines = t.select(F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "/").alias("path"), F.posexplode(F.split("value", r"\r?\n")).alias("pos", "line")).filter("line <> ''")
    r = F.from_csv("line", schemas.SEGMENT_TSV, {"sep": "\t", "quote": '"'})
    return lines.withColumn("r", r).select("path", "pos", "r.*")


def tsv_text(rows: DataFrame) -> DataFrame:
    """``(path, text)``: labels joined in order."""
    return rows.groupBy("path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "label"))), lambda x: x["label"]), " ").alias("text"))


def ctm(spark: SparkSession, path: str, below: bool = False) -> DataFrame:
    """Offsets of a CTM file: lines of at least five fields; the end is start plus duration. With ``below`` of all ``.ctm`` files in a
    folder, each with its ``path``."""
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.ctm").text(path) if below else spark.read.text(path)
    rows = lines.withColumn("path", F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "/")).withColumn("f", F.split(F.trim("value"), r"\s+")).filter(F.size("f") >= 5)
    get = lambda i: F.get("f", F.lit(i))
    rows = rows.select("path", get(0).alias("utt"), get(1).alias("channel"), get(2).cast("double").alias("start_time"), get(3).cast("double").alias("d"), get(4).alias("text"))
    rows = rows.select("path", "utt", "channel", "start_time", (F.col("start_time") + F.col("d")).alias("end_time"), "text")
    return rows if below else rows.drop("path")


def lexicon_rows(table: DataFrame, language: str) -> DataFrame:
    """Rows of a word table of one language that aren't marked deleted."""
    return table.filter((F.col("language") == F.lit(language)) & F.col("deletedAt").isNull())
