"""Language by scripts and stopwords over the first 2,000 characters; the policy; hooks for models."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values.
STOPWORDS = "the and of to in is for that with as are on be this by an or it from".split()
OTHER_SCRIPTS = "[\u0400-\u04FF\u0600-\u06FF\u0900-\u097F\u3040-\u30FF\u4E00-\u9FFF\uAC00-\uD7AF\u0590-\u05FF]"
SAMPLE = 2000


def detect(c: Column) -> Column:
    """non-latin, en or unknown."""
    s = F.substring(c, 1, SAMPLE)
    other, latin = F.regexp_count(s, F.lit(OTHER_SCRIPTS)), F.regexp_count(s, F.lit("[A-Za-z]"))
    words = F.regexp_count(s, F.lit("[A-Za-z]+"))
    stop = F.regexp_count(F.lower(s), F.lit(rf"(?<![a-z])(?:{'|'.join(STOPWORDS)})(?![a-z])"))
    return (
        F.when(c.isNull() | ~c.rlike(r"[^\s\p{Z}]"), "unknown")
        .when((other > latin) & (other > 10), "non-latin")
        .when((words >= 10) & (stop / words >= 0.05), "en")
        .otherwise("unknown")
    )


def allowed(lang: Column, languages: tuple[str, ...] = ("en",)) -> Column:
    return lang.isin(*languages, "unknown")


Translator = Callable[[Column], Column]


def no_translator(c: Column) -> Column:
    """The default: nothing can be translated (null), so what isn't allowed is dropped."""
    return F.lit(None).cast("string")


#: Backends by name; a backend takes a text column and returns a text column or null.
BACKENDS: dict[str, Translator] = {"none": no_translator}


def normalize_code(code: Column) -> Column:
    """`en-US` and `EN_us` are `en`."""
    return F.nullif(F.lower(F.regexp_extract(F.trim(code), r"^([A-Za-z]+)", 1)), F.lit(""))
