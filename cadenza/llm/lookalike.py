"""One consistent form for text that looks the same (problem 2).

Per text: full-width forms become ordinary ones, letters and combining accents are joined (NFC), invisible
characters go, every kind of space but the line breaks becomes an ordinary one. Then the script-aware repair:
the dominant script of a token is decided by the letters that have no look-alike in the other scripts, and
look-alikes are substituted in tokens that mix scripts, when, and only when, the result exists in the corpus vocabulary.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..operators.skew import join_hot, join_lookup
from ..runtime import materialize

# Letters of other scripts that look like a Latin letter.
CYRILLIC_LATIN = dict(zip("аеорсухіѕјһԁԛԝАВЕЅІЈКМНОРСТУХԌԚԜ", "aeopcyxisjhdqwABESIJKMHOPCTYXGQW", strict=True))
GREEK_LATIN = dict(zip("αινορυΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aivopuABEZHIKMNOPTYX", strict=True))
RARE_LATIN = dict(zip("ӏӀѵүѴҮγϲϳϹͿօսոհզՕՏԼՍ", "lIvyVYycjCJounhqOSLU", strict=True))
TO_LATIN = CYRILLIC_LATIN | GREEK_LATIN | RARE_LATIN
FROM_LATIN = {
    "CYRILLIC": {v: k for k, v in CYRILLIC_LATIN.items()},
    "GREEK": {v: k for k, v in GREEK_LATIN.items()},
    "ARMENIAN": {},
}

INVISIBLE = [0x00AD, 0x034F, 0x061C, 0x180E, 0xFEFF, *range(0x200B, 0x2010), *range(0x202A, 0x202F), *range(0x2060, 0x2065), *range(0x2066, 0x2070), *range(0xFE00, 0xFE10)]
SPACES = [0x09, 0x0B, 0x0C, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
FULL_WIDTH = {c: unicodedata.normalize("NFKC", chr(c)) for c in (*range(0xFF01, 0xFF5F), *range(0xFFE0, 0xFFE7))}
_STAGE_ONE = FULL_WIDTH | dict.fromkeys(INVISIBLE) | dict.fromkeys(SPACES, " ")

_CHANGED = re.compile("[" + "".join(re.escape(chr(c)) for c in _STAGE_ONE) + "]")

#: A token: letters, digits and the accents that could not be joined with them.
_PART = r"(?:[^\W_]|[̀-ͯ])"
_TOKEN = re.compile(rf"{_PART}+")
_FOREIGN = re.compile(r"[Ͱ-ԯԱ-և]")
_ASCII_TOKEN = re.compile(r"[A-Za-z]+")
_LATIN = re.compile(r"[A-Za-zªºÀ-ɏɐ-ʯḀ-ỿ]")
_CYRILLIC = re.compile(r"[Ѐ-ԯ]")
_GREEK = re.compile(r"[Ͱ-Ͽἀ-῿]")
_ARMENIAN = re.compile(r"[Ա-և]")
SUSPECTS = "array<struct<token:string,fix:string,mixed:boolean>>"


def plain_form(text: str) -> str:
    """The first half: widths, accents, invisible characters and spaces."""
    if text.isascii():
        return text if not ("\t" in text or "\x0b" in text or "\x0c" in text) else text.translate(_STAGE_ONE)
    return unicodedata.normalize("NFC", text.translate(_STAGE_ONE) if _CHANGED.search(text) else text)


def _script(c: str) -> str | None:
    if _LATIN.match(c):
        return "LATIN"
    if _CYRILLIC.match(c):
        return "CYRILLIC"
    if _GREEK.match(c):
        return "GREEK"
    if _ARMENIAN.match(c):
        return "ARMENIAN"
    return None


def _letters(token: str) -> list[tuple[str, str]]:
    """Base letters of a token with their scripts, accents taken off."""
    return [(c, s) for c in unicodedata.normalize("NFD", token) if (s := _script(c))]


def _exclusive(letters: list[tuple[str, str]]) -> dict[str, int]:
    """Letters by script that no other script has a look-alike of; for Latin: not in Cyrillic."""
    n: dict[str, int] = {}
    for c, s in letters:
        if c not in (FROM_LATIN["CYRILLIC"] if s == "LATIN" else TO_LATIN):
            n[s] = n.get(s, 0) + 1
    return n


def convert(token: str, script: str) -> str | None:
    """The token with every letter in ``script``, or None if some letter has no look-alike there."""
    out = []
    for c in unicodedata.normalize("NFD", token):
        s = _script(c)
        if s and s != script:
            latin = TO_LATIN.get(c) if s != "LATIN" else c
            c = latin if script == "LATIN" else FROM_LATIN[script].get(latin or "")
            if c is None:
                return None
        out.append(c)
    return unicodedata.normalize("NFC", "".join(out))


@lru_cache(maxsize=200_000)
def _read(token: str) -> tuple[frozenset[str], dict[str, int]]:
    """The scripts of a token's letters, and its exclusive letters by script."""
    letters = _letters(token)
    return frozenset(s for _, s in letters), _exclusive(letters)


def latin_look(text: str) -> str:
    """Every letter that has a Latin look-alike as that one."""
    return unicodedata.normalize("NFC", "".join(TO_LATIN.get(c, c) for c in unicodedata.normalize("NFD", text)))


def dominant_script(text: str) -> str | None:
    """The script of most letters that belong to one script only; None where there is no such letter."""
    n: dict[str, int] = {}
    for token in _TOKEN.findall(text):
        for s, k in _read(token)[1].items():
            n[s] = n.get(s, 0) + k
    return max(sorted(n), key=lambda s: n[s]) if n else None


def suspects(base: str) -> list[tuple[str, str, bool]]:
    """``(token, form it may be repaired to, whether the token mixes scripts)``. A token all in look-alikes of another
    script than the text's counts too, as unmixed."""
    if base.isascii() or not _FOREIGN.search(base):
        return []
    found: dict[tuple[str, str], bool] = {}
    whole: str | None = ""
    tokens = set(_TOKEN.findall(base))
    for token in sorted(tokens):
        if not _FOREIGN.search(token):
            continue
        scripts, own = _read(token)
        if len(scripts) > 1:
            order = sorted(own, key=lambda s: -own[s])
            if not order:
                whole = dominant_script(base) if whole == "" else whole
                order = [whole or "LATIN"]
                order += [s for s in ("LATIN", "CYRILLIC") if s not in order]
            for s in order:
                if fix := convert(token, s):
                    found[token, fix] = True
        elif not own:
            whole = dominant_script(base) if whole == "" else whole
            to = whole or "LATIN"
            if to not in scripts and (fix := convert(token, to)):
                found[token, fix] = False
    # also a Latin token inside a text of another script
    whole = dominant_script(base) if whole == "" else whole
    if whole in FROM_LATIN:
        for token in sorted(t for t in tokens if _ASCII_TOKEN.fullmatch(t)):
            if not _read(token)[1] and (fix := convert(token, whole)):
                found[token, fix] = False
    return [(t, f, mixed) for (t, f), mixed in found.items()]


def repair(base: str, mapping: dict[str, str]) -> str:
    """``base`` with the tokens of ``mapping`` replaced, whole tokens only."""
    return _TOKEN.sub(lambda m: mapping.get(m.group(), m.group()), base) if mapping else base


def choose(found: list[tuple[str, str, bool]], vocabulary) -> dict[str, str]:
    """Which repairs hold: those whose result is in the vocabulary (lower case)."""
    out: dict[str, str] = {}
    for token, fix, _ in found:
        if token not in out and fix.lower() in vocabulary:
            out[token] = fix
    return out


def unify_local(text: str, vocabulary) -> str:
    """Both halves for one text and a vocabulary at hand."""
    base = plain_form(text)
    return repair(base, choose(found, vocabulary)) if (found := suspects(base)) else base


def _stage_one(text: pd.Series) -> pd.DataFrame:
    rows = []
    for t in text:
        if t is None:
            rows.append((None, []))
        else:
            base = plain_form(t)
            rows.append((base, [{"token": a, "fix": b, "mixed": c} for a, b, c in suspects(base)]))
    return pd.DataFrame(rows, columns=["base", "suspects"])


def _repair_batch(base: pd.Series, tokens: pd.Series, fixes: pd.Series) -> pd.Series:
    return pd.Series([b if b is None or t is None else repair(b, dict(zip(t, f, strict=True))) for b, t, f in zip(base, tokens, fixes, strict=True)], dtype=object)


def _known_tokens(text: Column) -> Column:
    """Lower-case tokens with the accents that could not be joined, as the vocabulary has them, and maybe empty ones."""
    return F.split(F.lower(text), r"[^\p{L}\p{N}\x{0300}-\x{036F}]+")


def words_text(text: Column) -> Column:
    """The words of a text that is in the consistent form already, joined by one space."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def words_number(joined: Column) -> Column:
    """How many words a text of :func:`words_text` has."""
    return F.when(joined == "", 0).otherwise(F.char_length(joined) - F.char_length(F.translate(joined, " ", "")) + 1)


def unify(df: DataFrame, columns: dict[str, str], vocabulary: DataFrame | None = None) -> DataFrame:
    """``df`` with a column for each entry of ``columns`` (source column to new column) in the consistent form.

    Texts of ASCII alone never leave the JVM. The rest goes through Arrow once and is written to the shared folder with a
    number for each row; rows with tokens to repair, which are few, get the accepted repairs by that number, the others
    by-pass the join. The vocabulary is all tokens of all rows that are not under suspicion themselves, and those of the
    column ``word`` of ``vocabulary``; the repaired form of a token that mixes scripts counts too if a token spelled
    otherwise is repaired to it as well, as then two damaged copies of one word have no clean copy. A token is repaired only
    to what the vocabulary holds. Null gives null, an empty or blank text stays one (of ordinary spaces); rows are neither
    dropped nor added, repeated ones stay. New columns replace existing ones of the same name.
    """
    for source, new in columns.items():
        df = _unify_one(df, source, new, vocabulary)
    return df


def _unify_one(df: DataFrame, source: str, new: str, vocabulary: DataFrame | None) -> DataFrame:
    df = df.withColumn("__cz_text", F.col(source).cast("string"))
    plain = F.octet_length("__cz_text") == F.char_length("__cz_text")
    ascii_rows = df.filter(F.col("__cz_text").isNull() | plain).withColumn("__cz_u", F.translate("__cz_text", "\t\x0b\x0c", "   "))
    other = df.filter(~plain).withColumn("__cz_s", F.pandas_udf(_stage_one, f"base string, suspects {SUSPECTS}")("__cz_text"))
    other = materialize(other.withColumn("__cz_row", F.monotonically_increasing_id()))
    clean = other.filter(F.size("__cz_s.suspects") == 0).withColumn("__cz_u", F.col("__cz_s.base"))
    dirty = other.filter(F.size("__cz_s.suspects") > 0)

    # written, so that its size is known before the join with the tokens of the whole corpus is planned
    pairs = materialize(dirty.select(F.explode("__cz_s.suspects").alias("s")).select("s.*", F.lower("s.fix").alias("word")).distinct())
    wanted = pairs.select("word").distinct()
    doubted = dirty.select(F.array_except(_known_tokens(F.col("__cz_s.base")), F.transform("__cz_s.suspects", lambda s: F.lower(s["token"]))).alias("w"))
    known = (
        ascii_rows.select(F.split(F.lower("__cz_u"), "[^a-z0-9]+").alias("w"))
        .unionByName(clean.select(_known_tokens(F.col("__cz_u")).alias("w")))
        .unionByName(doubted)
        .select(F.explode("w").alias("word"))
        .filter("word <> ''")
    )
    if vocabulary is not None:
        known = known.unionByName(vocabulary.select(F.lower("word").alias("word")))
    # an inner join: a semi join would be pushed below the distinct, and every token be shuffled
    present = known.distinct().join(wanted, "word").withColumn("known", F.lit(True))
    twice = pairs.filter("mixed").groupBy("word").agg(F.countDistinct(F.lower("token")).alias("k")).filter("k > 1").select("word", F.lit(True).alias("twice"))
    accepted = materialize(
        pairs.join(present, "word", "left")
        .join(twice, "word", "left")
        .filter(F.coalesce("known", F.lit(False)) | (F.col("mixed") & F.coalesce("twice", F.lit(False))))
        .groupBy("token")
        .agg(F.min_by("fix", F.struct(F.when(F.col("known"), 0).otherwise(1), F.col("fix"))).alias("fix"))
    )
    spots = dirty.select("__cz_row", F.explode(F.array_distinct(F.transform("__cz_s.suspects", lambda s: s["token"]))).alias("token"))
    fixes = join_lookup(spots, accepted, ["token"], F.col("__cz_row")).groupBy("__cz_row").agg(F.collect_list("token").alias("__cz_tokens"), F.collect_list("fix").alias("__cz_fixes"))
    mended = dirty.join(fixes, "__cz_row", "left").withColumn("__cz_u", F.pandas_udf(_repair_batch, "string")("__cz_s.base", "__cz_tokens", "__cz_fixes"))
    keep = [F.col(c) for c in df.columns if c not in (new, "__cz_text")]
    parts = [x.select(*keep, F.col("__cz_u").alias(new)) for x in (ascii_rows, clean, mended)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _spelled(df: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Rows ``(rid, form, raw)`` of texts that are neither null nor blank, form and text as hashes, and the forms of more
    than one spelling with ``class_id, spellings, rows``."""
    rows = df.select(F.col(id_col).alias("rid"), F.col(text_col).alias("raw")).filter(F.col("raw").isNotNull() & F.col("rid").isNotNull())
    rows = materialize(unify(rows, {"raw": "form"}).filter(F.col("form").rlike(r"\S")).select("rid", F.md5("form").alias("form"), F.md5("raw").alias("raw")))
    spelled = rows.groupBy("form", "raw").agg(F.count(F.lit(1)).alias("n"), F.min("rid").alias("first"))
    classes = spelled.groupBy("form").agg(F.min("first").alias("class_id"), F.count(F.lit(1)).alias("spellings"), F.sum("n").alias("rows")).filter("spellings > 1")
    return rows, materialize(classes)


def look_alike_classes(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, class_id, spellings, rows)``: the rows whose text has look-alikes that differ from it in their code points; a
    class is all rows of one consistent form, its id the smallest id, with the number of its spellings and rows. Null and
    blank texts and null ids take no part."""
    rows, classes = _spelled(df, id_col, text_col)
    return join_hot(rows.select("rid", "form"), classes, ["form"], F.col("rid")).select(F.col("rid").alias(id_col), "class_id", "spellings", "rows")


def look_alike_pairs(df: DataFrame, id_col: str, text_col: str, salt_rows: int = 20_000) -> DataFrame:
    """``(a, b)`` with ``a < b``: rows whose texts differ in their code points and are equal in the consistent form.

    Null and blank texts take no part. Only classes of more than one spelling are joined; in a class, rows of the
    commonest spellings are salted by the class's size and rows of the rarer ones are copied to the salts, so no task
    holds a large class.
    """
    rows, classes = _spelled(df, id_col, text_col)
    rows = join_hot(rows, classes.select("form", "rows"), ["form"], F.col("rid"))
    spellings = rows.groupBy("form", "raw").agg(F.count(F.lit(1)).alias("n"), F.first("rows").alias("rows"))
    ranked = spellings.withColumn("r", F.row_number().over(W.partitionBy("form").orderBy(F.desc("n"), "raw"))).select("form", "raw", "r", F.ceil(F.col("rows") / salt_rows).cast("int").alias("salts"))
    members = materialize(join_hot(rows.select("rid", "form", "raw"), ranked, ["form", "raw"], F.col("rid")).select("rid", "form", "r", "salts"))
    left = members.select("form", F.col("rid").alias("x"), F.col("r").alias("rx"), F.pmod(F.xxhash64("rid"), F.col("salts").cast("bigint")).alias("salt"))
    right = members.filter("r > 1").select(
        "form", F.col("rid").alias("y"), F.col("r").alias("ry"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("salts").cast("bigint") - 1)).alias("salt")
    )
    return left.join(right, ["form", "salt"]).filter("rx < ry").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).filter("a < b")
