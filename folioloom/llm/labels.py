"""Language labels in their many spellings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The languages handled, in the order of their bits.
LANGUAGES = ("en", "de", "fr", "es", "it", "ru", "ch")

#: Codes and English names of each language.
SPELLINGS = {
    "en": ("en", "eng", "english"),
    "de": ("de", "deu", "ger", "german"),
    "fr": ("fr", "fra", "fre", "french"),
    "es": ("es", "spa", "spanish", "castilian"),
    "it": ("it", "ita", "italian"),
    "ru": ("ru", "rus", "russian", "east_slavic", "cyrillic"),
    "ch": ("ch", "ch_server", "zh", "zho", "chi", "chinese", "mandarin"),
}

_BY_SPELLING = {s: lang for lang, all_ in SPELLINGS.items() for s in all_}


def normal_label(label: Column) -> Column:
    """The language a label names, else null.

    Case and blanks at the ends don't matter; a region or script after "-" or
    "_" is cut off unless the whole label is known ("ch_server").
    """
    whole = F.lower(F.trim(label))
    known = F.create_map(*[F.lit(x) for pair in _BY_SPELLING.items() for x in pair])
    return F.coalesce(F.try_element_at(known, whole), F.try_element_at(known, F.split_part(F.translate(whole, "_", "-"), F.lit("-"), F.lit(1))))


def file_label(file_names: Column, lang_list: Column, position: Column) -> Column:
    """The entry of ``lang_list`` for the file at ``position`` (from 0): its own if both lists are equally long, else the first."""
    same = F.size(lang_list) == F.size(file_names)
    return normal_label(F.when(same, F.get(lang_list, position)).otherwise(F.get(lang_list, F.lit(0))))
