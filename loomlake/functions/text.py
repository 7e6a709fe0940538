"""Text normalization, n-grams, passages and language statistics."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: White space of sources beyond ASCII: fixed values.
SPACES = "[\\s\\u00a0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"


@F.pandas_udf(StringType())
def nfc(values: pd.Series) -> pd.Series:
    """NFC with LF line ends; the JVM has no such function, and ASCII texts pass as they are."""
    return values.map(lambda t: t if t is None else unicodedata.normalize("NFC", t.replace("\r\n", "\n").replace("\r", "\n")))


def fold_space(text: Column) -> Column:
    """Runs of white space as one space, trimmed."""
    return F.trim(F.regexp_replace(text, SPACES + "+", " "))


def source_text(text: Column) -> Column:
    """Trimmed of all Unicode white space; empty is null."""
    return F.nullif(F.regexp_replace(text, f"^{SPACES}+|{SPACES}+$", ""), F.lit(""))


#: First digit of each script's ten decimal digits in the basic plane: fixed values.
_ZEROS = "0٠۰߀०০੦૦୦௦౦೦൦෦๐໐༠၀႐០᠐᥆᧐᪀᪐᭐᮰᱀᱐꘠꣐꤀꧐꧰꩐꯰０"


def ascii_digits(text: Column) -> Column:
    """Decimal digits of all scripts (basic plane) as 0-9."""
    return F.translate(text, "".join(chr(ord(z) + k) for z in _ZEROS for k in range(10)), "0123456789" * len(_ZEROS))


def source_integer(text: Column) -> Column:
    """A non-negative whole number in the digits of any script; others, and numbers beyond 64 bits, are null."""
    t = ascii_digits(source_text(text))
    return F.when(t.rlike("^[0-9]+$"), t.try_cast("long"))


def day(text: Column) -> Column:
    """YYYYMMDD as a date; anything else, impossible days too, is null."""
    t = source_text(text)
    return F.when(t.rlike("^[0-9]{8}$"), F.to_date(F.try_to_timestamp(t, F.lit("yyyyMMdd"))))


def list_parts(text: Column) -> Column:
    """Trimmed non-empty parts between commas."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")


def categories(codes: Column, names: Column) -> Column:
    """Codes and names of two parallel lists, by place."""
    return F.arrays_zip(list_parts(codes).alias("code"), list_parts(names).alias("name"))


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^\\p{L}\\p{N}]+"), lambda w: w != "")


def char_ngrams(word: Column, n: int) -> Column:
    """Joined from the letters, as a substring of a UTF-8 text is found from its start (quadratic for long texts)."""
    letters = F.split(F.coalesce(word, F.lit("")), "")
    grams = letters
    for i in range(2, n + 1):
        grams = F.zip_with(grams, F.slice(letters, F.lit(i), F.size(letters)), lambda a, b: F.concat(a, b))
    return F.filter(grams, lambda g: F.length(g) == n)


def letter_stats(text: Column) -> Column:
    """struct<letters, hangul, latin, share of hangul>."""
    letters = F.length(F.regexp_replace(text, "[^\\p{L}]", ""))
    hangul = F.length(F.regexp_replace(text, "[^가-힣]", ""))
    latin = F.length(F.regexp_replace(text, "[^A-Za-z]", ""))
    return F.struct(letters.alias("letters"), hangul.alias("hangul"), latin.alias("latin"), F.try_divide(hangul, letters).alias("hangul_share"))


def language_established(text: Column, locale: Column, letters: int = 100, share: float = 0.3) -> Column:
    s = letter_stats(text)
    return (F.coalesce(s["hangul"], F.lit(0)) >= letters) & (F.coalesce(s["hangul_share"], F.lit(0.0)) >= share) | F.coalesce(F.lower(locale).startswith("ko"), F.lit(False))


def passages(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, n, passage, start, stop): lines with half-open code point offsets in the text with LF line ends."""
    lines = df.select(key, F.posexplode(F.split(F.coalesce(text, F.lit("")), "\n")).alias("n", "passage"))
    before = Window.partitionBy(key).orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("passage") + 1).over(before), F.lit(0))
    return lines.withColumn("start", start).withColumn("stop", F.col("start") + F.length("passage"))


def scope_families(text: Column, families: dict[str, str]) -> Column:
    """Names of the families whose pattern occurs, in the given order."""
    return F.array_compact(F.array(*[F.when(F.coalesce(text, F.lit("")).rlike("(?i)" + p), F.lit(n)) for n, p in families.items()]))


def percent_encode(text: Column) -> Column:
    return F.replace(F.url_encode(text), F.lit("+"), F.lit("%20"))
