"""Text functions: columns in, columns out, all inside the JVM but for the ASCII fold."""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

#: Letters that decomposition leaves alone, with their usual ASCII spelling.
LETTERS = {"ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ł": "l", "Ł": "L", "þ": "th", "Þ": "Th", "ð": "d", "Ð": "D", "ı": "i", "–": "-", "—": "-", "‘": "'", "’": "'", "“": '"', "”": '"'}
WHITE = "[\\s ]+"


def fold(text: str | None) -> str | None:
    """Latin text without accents; letters of other scripts have no ASCII form here and go."""
    if text is None or text.isascii():
        return text
    spelled = "".join(LETTERS.get(c, c) for c in text)
    return unicodedata.normalize("NFKD", spelled).encode("ascii", "ignore").decode()


@pandas_udf(StringType())
def _fold(texts):
    return texts.map(fold)


def ascii_fold(text: Column) -> Column:
    """Only rows that aren't ASCII already go through Python."""
    return F.when(text.rlike("^[\\x00-\\x7F]*$"), text).otherwise(_fold(text))


def collapse(text: Column) -> Column:
    """Runs of white space become one space; ends are trimmed."""
    return F.trim(F.regexp_replace(text, "\\s+", " "))


def collapse_spaces(text: Column) -> Column:
    """Runs of plain spaces alone become one space."""
    return F.regexp_replace(text, " +", " ")


def canon(text: Column, corrections: Mapping[str, str] | None = None) -> Column:
    """Trimmed upper case with single spaces, then a correction if there is one for it."""
    plain = F.trim(F.regexp_replace(F.upper(text), WHITE, " "))
    for wrong, right in (corrections or {}).items():
        plain = F.when(plain == wrong, F.lit(right)).otherwise(plain)
    return plain


def drop_trailing_code(text: Column, digits: int = 16) -> Column:
    """Without a bracketed code of ``digits`` digits at the end."""
    return canon(F.regexp_replace(text, f"\\([0-9]{{{digits}}}\\)\\s*$", ""))


def clean_name(text: Column, prefixes: Sequence[str] = (), suffixes: Sequence[str] = (), folded: bool = True) -> Column:
    """Upper-cased name without the prefixes and suffixes, tried one after the other in the order given (several may
    go), trimmed, with single spaces; hyphens become spaces at the very end."""
    name = F.upper(ascii_fold(text) if folded else text)
    for prefix in prefixes:
        name = F.when(name.startswith(prefix), F.substring(name, F.lit(len(prefix) + 1), F.length(name))).otherwise(name)
    for suffix in suffixes:
        name = F.when(name.endswith(suffix), F.substring(name, F.lit(1), F.length(name) - len(suffix))).otherwise(name)
    return F.replace(collapse(name), F.lit("-"), F.lit(" "))


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def after_last(text: Column, mark: str = ":", without: str = ")") -> Column:
    return F.trim(F.replace(F.substring_index(text, mark, -1), F.lit(without), F.lit("")))


def without(text: Column, part: str) -> Column:
    return F.replace(text, F.lit(part), F.lit(""))


def head_and_rest(text: Column) -> Column:
    """struct(head, rest): the first word, and the others joined."""
    words = F.split(F.trim(text), "\\s+")
    return F.struct(words[0].alias("head"), F.array_join(F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))), " ").alias("rest"))


def file_name_parts(name: Column) -> Column:
    """struct(prefix, date) of ``prefix.date.csv.7z``."""
    parts = F.split(name, "\\.")
    return F.struct(parts[0].alias("prefix"), F.try_element_at(parts, F.lit(2)).alias("date"))


def coded_file_name(stem: str, code: Column, suffix: str) -> Column:
    return F.format_string(f"{stem}%s{suffix}", code)


def with_query(url: Column, parameters: Mapping[str, Column | str]) -> Column:
    """The url with query parameters replaced or added, encoded, in the order old, then new."""
    query = F.coalesce(F.try_parse_url(url, F.lit("QUERY")), F.lit(""))
    old = F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.substring_index(p, "=", 1).isin([*parameters]))
    new = F.array(*[F.concat(F.lit(k + "="), F.url_encode(v if isinstance(v, Column) else F.lit(v))) for k, v in parameters.items()])
    return F.concat(F.substring_index(F.substring_index(url, "#", 1), "?", 1), F.lit("?"), F.array_join(F.concat(old, new), "&"))


def entity_id(number: Column) -> Column:
    return F.concat(F.lit("Q"), number.cast("string"))


def entity_number(entity: Column) -> Column:
    return F.substring(entity, 2, 30).try_cast("bigint")


def best_label(labels: Column, latin: Sequence[str], otherwise: str = "NA") -> Column:
    """Label of a map language -> text: English; else the last by language among the ``latin`` ones, folded; else ``otherwise``."""
    known = F.filter(F.array_sort(F.map_keys(labels)), lambda k: k.isin(list(latin)))
    spare = F.try_element_at(labels, F.try_element_at(known, F.lit(-1)))
    return F.coalesce(F.try_element_at(labels, F.lit("en")), ascii_fold(spare), F.lit(otherwise))


def field(text: Column, mark: str, at: int) -> Column:
    """The ``at``-th (from 0) part of a delimited value; null if there are fewer."""
    return F.try_element_at(F.split(text, mark), F.lit(at + 1))


def page_count(options: Column) -> Column:
    """Options of a page list, less the one that isn't a page."""
    return F.greatest(F.size(options) - 1, F.lit(0))


def extract(text: Column, pattern: str, group: int = 1) -> Column:
    """A pattern's group; null where it isn't found."""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))
