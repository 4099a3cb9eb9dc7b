"""Functions without a native form, as Arrow UDFs."""

from __future__ import annotations

import difflib
import functools
import html
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from .. import config as C

_GAP = re.compile(r"[^a-z0-9]+")


def fold_key(text: str | None) -> str:
    """Case-folded, without combining marks, other than a-z and 0-9 as single spaces."""
    t = unicodedata.normalize("NFKD", (text or "").replace("’", "'").casefold())
    return _GAP.sub(" ", "".join(c for c in t if not unicodedata.combining(c))).strip()


@pandas_udf(T.StringType())
def unicode_key(x: pd.Series) -> pd.Series:
    """``fold_key`` of each text, each distinct one folded once."""
    return x.map({v: fold_key(v) for v in x.unique()})


@functools.lru_cache(1 << 14)
def _ratio(x: str | None, y: str | None) -> float:
    return 0.0 if not x or not y else 1.0 if x == y else difflib.SequenceMatcher(None, x, y).ratio()


@pandas_udf(T.DoubleType())
def name_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp similarity of two keys: 1 if equal, 0 if either is empty; the last pairs are remembered."""
    return pd.Series([_ratio(x, y) for x, y in zip(a, b)], dtype="float64")


@pandas_udf(T.StringType())
def unescape_html(x: pd.Series) -> pd.Series:
    return x.map(lambda v: v if v is None else " ".join(html.unescape(v).split()))


@pandas_udf(T.StringType())
def _compose(x: pd.Series) -> pd.Series:
    return x.map(lambda v: v if v is None else unicodedata.normalize("NFKC", v))


_QUOTES = (("’", "'"), ("‘", "'"), ("`", "'"), ("–", "-"), ("—", "-"), ("−", "-"), ("«", '"'), ("»", '"'), ("“", '"'), ("”", '"'))
#: Detached accents and the capitals that they make.
_DETACHED = (("[´́]", dict(zip("AEIOU", "ÁÉÍÓÚ"))), ("̀", dict(zip("AE", "ÀÈ"))), ("[¨̈]", dict(zip("AEIOU", "ÄËÏÖÜ"))))


def ocr_text(x: Column) -> Column:
    """Scanned text in composed form with plain quotes and dashes, detached accents and known capitals repaired."""
    from .text import clean_title, squeeze, strip_wrappers

    t = F.replace(_compose(F.coalesce(x, F.lit(""))), F.lit("­"), F.lit(""))
    for old, new in _QUOTES:
        t = F.replace(t, F.lit(old), F.lit(new))
    t = strip_wrappers(F.regexp_replace(t, r'[\\"]{2,}', '"'))
    for mark, made in _DETACHED:
        for plain, capital in made.items():
            t = F.regexp_replace(t, rf"(?i){plain}\s*{mark}\s*", capital)
    t = squeeze(F.regexp_replace(t, r"[Cc]\s*,\s*", "Ç"))
    t = clean_title(F.regexp_replace(t, r"(?iU)\bI\s+er\b", "Ier"))
    for plain, right in C.ACCENTS.items():
        t = F.regexp_replace(t, rf"(?iU)\b{plain}\b", right)
    return F.regexp_replace(squeeze(t), "^[ ,;]+|[ ,;]+$", "")
