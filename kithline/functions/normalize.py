"""Text normalisation as Column functions: cleaned names and addresses, legal suffixes, postal codes.

Two families that must not be mixed: `clean_*` contracts words ("limited" to "ltd"), `raw_*` expands
them ("ltd" to "limited"). Everything runs in the JVM but Unicode decomposition and transliteration,
which Spark lacks; an Arrow UDF gets only the texts that have characters beyond ASCII.
"""

from __future__ import annotations

import re
import unicodedata
from functools import reduce
from itertools import chain

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Name tokens and their short forms.
NAME_TOKENS = {
    "limited": "ltd", "ltd": "ltd", "private": "pvt", "pvt": "pvt", "incorporated": "inc", "incorporation": "inc", "inc": "inc",
    "corporation": "corp", "corp": "corp", "company": "co", "co": "co", "llp": "llp", "llc": "llc", "pc": "pc", "pllc": "pllc",
    "lp": "lp", "enterprises": "ent", "enterprise": "ent", "and": "and",
}
# Stems that stand for a short form where no name token fits, in order.
NAME_STEMS = {"limit": "ltd", "praiv": "pvt", "priv": "pvt", "corp": "corp", "compan": "co", "incorp": "inc"}
# Short forms that are a legal suffix at the end of a name.
LEGAL_SUFFIXES = ["ltd", "pvt", "inc", "corp", "co", "llp", "llc", "pc", "pllc", "lp"]
# Address tokens and their short forms.
ADDRESS_TOKENS = {
    "street": "st", "st": "st", "road": "rd", "rd": "rd", "avenue": "ave", "ave": "ave", "boulevard": "blvd", "blvd": "blvd",
    "drive": "dr", "dr": "dr", "lane": "ln", "ln": "ln", "apartment": "apt", "apt": "apt", "number": "no", "no": "no",
    "floor": "fl", "fl": "fl", "flr": "fl", "building": "bldg", "bldg": "bldg", "highway": "hwy", "hwy": "hwy",
    "opposite": "opp", "opp": "opp", "near": "near", "post": "po", "po": "po", "box": "box", "suite": "ste", "ste": "ste", "unit": "unit",
}
# Long forms of name and address tokens of the raw path.
RAW_NAME_TOKENS = {
    "corp": "corporation", "inc": "incorporated", "ltd": "limited", "co": "company", "pvt": "private", "intl": "international",
    "mfg": "manufacturing", "assoc": "associates", "bros": "brothers",
}
RAW_ADDRESS_TOKENS = {
    "rd": "road", "st": "street", "ave": "avenue", "blvd": "boulevard", "ln": "lane", "dr": "drive", "apt": "apartment",
    "fl": "floor", "flr": "floor", "bldg": "building", "no": "number", "nr": "near", "opp": "opposite", "sec": "sector",
    "ngr": "nagar", "hwy": "highway", "ste": "suite", "sq": "square",
}
# Names of countries of the raw path.
COUNTRY_NAMES = {"us": "united states", "usa": "united states", "u.s.": "united states", "u.s.a.": "united states", "united states of america": "united states", "in": "india", "fr": "france"}
# Latin letters without a decomposition, and Devanagari as written in Latin letters.
LATIN = {"ß": "ss", "ẞ": "SS", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ł": "l", "Ł": "L", "þ": "th", "Þ": "Th", "ð": "d", "Ð": "D", "ı": "i"}
DEVANAGARI = {
    "अ": "a", "आ": "aa", "इ": "i", "ई": "ii", "उ": "u", "ऊ": "uu", "ए": "e", "ऐ": "ai", "ओ": "o", "औ": "au",
    "क": "k", "ख": "kh", "ग": "g", "घ": "gh", "ङ": "ng", "च": "c", "छ": "ch", "ज": "j", "झ": "jh", "ञ": "ny",
    "ट": "tt", "ठ": "tth", "ड": "dd", "ढ": "ddh", "ण": "nn", "त": "t", "थ": "th", "द": "d", "ध": "dh", "न": "n",
    "प": "p", "फ": "ph", "ब": "b", "भ": "bh", "म": "m", "य": "y", "र": "r", "ल": "l", "व": "v",
    "श": "sh", "ष": "ss", "स": "s", "ह": "h",
    "ा": "aa", "ि": "i", "ी": "ii", "ु": "u", "ू": "uu", "े": "e", "ै": "ai", "ो": "o", "ौ": "au", "्": "", "ं": "N", "ः": "H", "ँ": "N", "़": "",
}

WHITE = r"[\s\x0B\x1C-\x1F]+"
_ACRONYM = r"(?<=[A-Za-z])\.(?=[A-Za-z])"


def transliterate(text: str) -> str:
    """ASCII of a text: compatibility form, dotted acronyms closed up, letters written in Latin; what has no rule goes."""
    text = re.sub(_ACRONYM, "", unicodedata.normalize("NFKC", text))
    out = []
    for c in text:
        if c.isascii():
            out.append(c)
        elif (known := LATIN.get(c, DEVANAGARI.get(c))) is not None:
            out.append(known)
        elif c.isdigit():
            out.append(str(unicodedata.digit(c)))
        else:
            out.append("".join(x for x in unicodedata.normalize("NFKD", c) if x.isascii()))
    return "".join(out)


def strip_marks(text: str) -> str:
    """The decomposed text without its combining characters."""
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


def _arrow(f):
    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(f, na_action="ignore")

    return run


def _where_wide(text: Column, wide, plain: Column) -> Column:
    """plain for ASCII texts, else wide (an Arrow UDF, which gets null for the former)."""
    is_wide = text.rlike(r"[^\x00-\x7F]")
    return F.when(is_wide, wide(F.when(is_wide, text))).otherwise(plain)


def to_ascii(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    return _where_wide(text, _arrow(transliterate), F.regexp_replace(text, _ACRONYM, ""))


def basic_clean(text: Column) -> Column:
    """ASCII, lower case, & as " and ", other signs as spaces, single spaces."""
    spaced = F.regexp_replace(F.replace(F.lower(to_ascii(text)), F.lit("&"), F.lit(" and ")), r"[^a-z0-9\s]", " ")
    return F.trim(F.regexp_replace(spaced, WHITE, " "))


def tokens(text: Column) -> Column:
    """Tokens between white space; none of an empty text."""
    return F.filter(F.split(text, WHITE), lambda x: x != "")


def _mapped(token: Column, table: dict[str, str]) -> Column:
    return F.try_element_at(F.create_map(*map(F.lit, chain.from_iterable(table.items()))), token)


def name_tokens(cleaned: Column) -> Column:
    """Tokens of a cleaned name, each in its short form."""

    def short(t: Column) -> Column:
        stem = reduce(lambda c, kv: c.when(t.startswith(kv[0]), kv[1]), NAME_STEMS.items(), F.when(F.lit(False), ""))
        return F.coalesce(_mapped(t, NAME_TOKENS), stem, t)

    return F.transform(tokens(cleaned), short)


def address_tokens(cleaned: Column) -> Column:
    return F.transform(tokens(cleaned), lambda t: F.coalesce(_mapped(t, ADDRESS_TOKENS), t))


def postal_code(address: Column, country: Column) -> Column:
    """The first US or Indian code in the raw address, as the country has it; of other countries the first US code, else Indian code."""
    address, country = F.coalesce(address, F.lit("")), F.coalesce(country, F.lit(""))
    us = F.regexp_extract(F.regexp_extract(address, r"(?U)\b\d{5}(?:-\d{4})?\b", 0), "^[^-]*", 0)
    india = F.regexp_extract(address, r"(?U)\b\d{6}\b", 0)
    return F.when(country == "US", us).when(country == "India", india).when(us != "", us).otherwise(india)


def clean_records(df: DataFrame) -> DataFrame:
    """df with business_name_clean, business_name_core, business_name_blockkey, legal_suffix, business_address_clean and postal_code; null name, address and country become empty."""
    filled = df.withColumns({c: F.coalesce(c, F.lit("")) for c in ("business_name", "business_address", "country")})
    cut = filled.withColumns({"_name": name_tokens(basic_clean(F.col("business_name"))), "_address": address_tokens(basic_clean(F.col("business_address")))})
    last = F.coalesce(F.array_max(F.transform("_name", lambda t, i: F.when(t.isin(LEGAL_SUFFIXES), -1).otherwise(i))), F.lit(-1))  # of the core
    core = F.slice("_name", F.lit(1), F.col("_last") + 1)
    return (
        cut.withColumn("_last", last)
        .withColumn("_core", core)
        .withColumns(
            {
                "business_name_clean": F.array_join("_name", " "),
                "business_name_core": F.array_join("_core", " "),
                "business_name_blockkey": F.array_join(F.array_sort("_core"), " "),
                "legal_suffix": F.array_join(F.slice("_name", F.col("_last") + 2, F.size("_name")), " "),
                "business_address_clean": F.array_join("_address", " "),
                "postal_code": postal_code(F.col("business_address"), F.col("country")),
            }
        )
        .drop("_name", "_address", "_last", "_core")
    )


def raw_base(text: Column) -> Column:
    """The raw path's cleaning: marks stripped, lower case, & as space, signs as spaces; letters of all scripts and _ stay; "nan", "none" and blanks are empty."""
    text = F.coalesce(text, F.lit(""))
    text = F.when(F.lower(F.trim(F.regexp_replace(text, WHITE, " "))).isin("nan", "none", ""), "").otherwise(text)
    bare = F.replace(F.lower(_where_wide(text, _arrow(strip_marks), text)), F.lit("&"), F.lit(" "))
    return F.trim(F.regexp_replace(F.regexp_replace(bare, r"[^\p{L}\p{N}_\s]", " "), WHITE, " "))


def _expanded(text: Column, table: dict[str, str]) -> Column:
    return F.array_join(F.transform(tokens(raw_base(text)), lambda t: F.coalesce(_mapped(t, table), t)), " ")


def raw_name(text: Column) -> Column:
    return _expanded(text, RAW_NAME_TOKENS)


def raw_address(text: Column) -> Column:
    return _expanded(text, RAW_ADDRESS_TOKENS)


def raw_country(text: Column) -> Column:
    low = F.lower(F.trim(F.coalesce(text, F.lit(""))))
    return F.coalesce(_mapped(low, COUNTRY_NAMES), low)
