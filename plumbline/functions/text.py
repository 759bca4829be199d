"""Names and text: Unicode keys (Python on distinct strings only), ASCII slugs, code point ranges, licence expressions."""

from __future__ import annotations

import re
import sys
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: What a key leaves out (hexadecimal code points and ranges): white space, dashes, underscore, joiners.
LEFT_OUT = "0009-000D 0020 0085 00A0 1680 2000-200A 2028 2029 202F 205F 3000 002D 00AD 2010-2014 2212 FE63 FF0D 005F 200B-200D 2060 FEFF"
_LEFT_OUT = dict.fromkeys(k for r in LEFT_OUT.split() for k in range(int(r.split("-")[0], 16), int(r.split("-")[-1], 16) + 1))
_OUT = re.compile("[" + "".join(re.escape(chr(k)) for k in _LEFT_OUT) + "]+")
_MARKS = re.compile("[" + "".join(c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c) == "Mn") + "]+")
#: Latin letters without a decomposition.
LETTERS = {"ß": "ss", "ẞ": "SS", "ł": "l", "Ł": "L", "ø": "o", "Ø": "O", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "đ": "d", "Đ": "D", "ð": "d", "Ð": "D", "þ": "th", "Þ": "TH", "ħ": "h", "Ħ": "H", "ı": "i", "ŀ": "l", "Ŀ": "L"}


def match_key_of(name: str) -> str:
    """Compatibility forms and case folded; white space, dashes, underscores and joiners dropped."""
    if name.isascii():
        return name.lower().translate(_LEFT_OUT)
    out = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", name).casefold())
    return unicodedata.normalize("NFC", _OUT.sub("", out))


def ascii_of(name: str) -> str:
    """Lower case, each letter as its ASCII base where it has one; what has none stays."""
    spelled = (LETTERS.get(c, c) for c in unicodedata.normalize("NFKC", name))
    bases = (c for part in spelled for c in unicodedata.normalize("NFKD", part))
    return "".join(filter(lambda c: not unicodedata.combining(c), bases)).lower()


def search_key_of(name: str) -> str:
    """The match key without marks."""
    return unmarked(match_key_of(name))


def unmarked(key: str) -> str:
    return key if key.isascii() else unicodedata.normalize("NFC", _MARKS.sub("", unicodedata.normalize("NFD", key)))


def keyed(names: DataFrame, name: str) -> DataFrame:
    """names, each of which stands there once, with match_key and search_key; nothing is dealt out again."""

    @F.pandas_udf("match string, search string")
    def keys_of(names: pd.Series) -> pd.DataFrame:
        match = names.map(match_key_of, na_action="ignore")
        return pd.DataFrame({"match": match, "search": match.map(unmarked, na_action="ignore")})

    return names.withColumn("_k", keys_of(F.col(name))).select(*names.columns, F.col("_k.match").alias("match_key"), F.col("_k.search").alias("search_key"))


def with_keys(df: DataFrame, name: str) -> DataFrame:
    """df with match_key and search_key of a name; Python sees each distinct name once."""
    return df.join(keyed(df.select(name).where(F.col(name).isNotNull()).distinct(), name), name, "left")


def folded(name: Column) -> Column:
    """The name in lower-case ASCII as far as it folds; only names with other characters go through Python."""

    @F.pandas_udf("string")
    def fold_of(names: pd.Series) -> pd.Series:
        return names.map(ascii_of, na_action="ignore")

    other = F.when(~name.rlike(r"^[\x00-\x7F]*$"), name)
    return F.coalesce(fold_of(other), F.lower(name))


def slug(name: Column) -> Column:
    """ASCII words in lower case, joined by hyphens; other letters are dropped."""
    return F.regexp_replace(F.regexp_replace(folded(name), "[^a-z0-9]+", "-"), "^-|-$", "")


def folder_slug(name: Column) -> Column:
    """Lower-case ASCII letters and digits alone."""
    return F.regexp_replace(folded(name), "[^a-z0-9]+", "")


def fold(name: Column) -> Column:
    """Match key of names known to be ASCII, without Python."""
    return F.regexp_replace(F.lower(name), "[\\s_-]+", "")


def code_points(ranges: Column) -> Column:
    """Code points of a list such as 'U+41-43, U+4??'; null for an empty, cut off ('...') or malformed list.

    A range that runs backwards or beyond 10FFFF is malformed; ends are looked at before anything is made.
    """
    parts = F.transform(F.split(F.upper(ranges), ","), lambda p: F.regexp_replace(p, r"^\s+|\s+$", ""))
    hexed = lambda x: F.conv(x, 16, 10).cast("int")

    def ends(p: Column) -> Column:
        body = F.substring(p, 3, 20)
        ranged = body.contains("-")
        low = F.when(ranged, F.split_part(body, F.lit("-"), F.lit(1))).otherwise(F.translate(body, "?", "0"))
        high = F.when(ranged, F.split_part(body, F.lit("-"), F.lit(2))).otherwise(F.translate(body, "?", "F"))
        return F.struct(hexed(low).alias("low"), hexed(high).alias("high"))

    good = F.forall(parts, lambda p: p.rlike(r"^U\+([0-9A-F]{1,6}(-[0-9A-F]{1,6})?|(?=.{1,6}$)[0-9A-F]*\?+)$"))
    pairs = F.when(good & (F.length(ranges) > 0) & ~ranges.contains("...") & ~ranges.contains("…"), F.transform(parts, ends))
    sound = F.forall(pairs, lambda e: (e["low"] <= e["high"]) & (e["high"] <= 0x10FFFF))
    return F.when(sound, F.array_sort(F.array_distinct(F.flatten(F.transform(pairs, lambda e: F.sequence(e["low"], e["high"]))))))


def runs(df: DataFrame, key: str, point: str) -> DataFrame:
    """Runs of consecutive code points by key; there are more partitions as the input has more splits, so a task's share doesn't grow with it."""
    from pyspark.sql import Window

    n, w = 8 * df.rdd.getNumPartitions(), Window.partitionBy(key).orderBy(point)
    isles = df.select(key, point).repartition(n, key, point).distinct().repartition(n, key).withColumn("_isle", F.col(point) - F.row_number().over(w))
    return isles.groupBy(key, "_isle").agg(F.min(point).alias("low"), F.max(point).alias("high")).drop("_isle")


