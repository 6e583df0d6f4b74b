"""Closest ASCII spelling of a text, computed inside the JVM.

Compatibility decomposition followed by dropping everything outside ASCII acts on each character
alone, so it is a per-character table. The table is derived from the Unicode database: characters
that become one ASCII character go through ``translate``; the few that become several go through a
map, and only for texts that still hold such a character.
"""

import json
import sys
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

_OUTSIDE = r"[^\x00-\x7F]"


@cache
def _spellings() -> tuple[str, str, str]:
    """Return ``(characters, their one-character spellings, JSON map of longer spellings)``."""
    single, several = {}, {}
    for point in range(0x80, sys.maxunicode + 1):
        character = chr(point)
        if not unicodedata.decomposition(character):
            continue
        spelling = unicodedata.normalize("NFKD", character).encode("ascii", "ignore").decode()
        if len(spelling) == 1:
            single[character] = spelling
        elif spelling:
            several[character] = spelling
    return "".join(single), "".join(single.values()), json.dumps(several, ensure_ascii=False)


def closest_ascii(text: Column) -> Column:
    """Replace characters by their ASCII spelling and drop those that have none.

    Longer spellings are looked up once for each different character of a text, not at each place of it.
    """
    characters, spellings, longer = _spellings()
    longer_map = F.from_json(F.lit(longer), "map<string,string>")

    def spelled(translated: Column) -> Column:
        different = F.array_distinct(F.regexp_extract_all(translated, F.lit(_OUTSIDE), F.lit(0)))
        known = F.filter(different, lambda c: F.map_contains_key(longer_map, c))
        put = F.aggregate(known, translated, lambda done, c: F.replace(done, c, F.element_at(longer_map, c)))
        return F.when(translated.rlike(_OUTSIDE), F.regexp_replace(put, _OUTSIDE, "")).otherwise(translated)

    # Within an array of one, so that the translated text is made once.
    once = F.transform(F.array(F.translate(text, characters, spellings)), spelled)
    return F.when(text.rlike(_OUTSIDE), F.get(once, F.lit(0))).otherwise(text)
