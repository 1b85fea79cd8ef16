"""Lookups of the printed canon, for parsers of sources that cite it. Data with a canon of its own bring their own tables."""

from __future__ import annotations

import re

# Id, name, OSIS code of each book in canonical order.
BOOKS = """
GEN Genesis Gen|EXO Exodus Exod|LEV Leviticus Lev|NUM Numbers Num|DEU Deuteronomy Deut|JOS Joshua Josh|JDG Judges Judg|RUT Ruth Ruth|1SA 1_Samuel 1Sam|2SA 2_Samuel 2Sam|1KI 1_Kings 1Kgs|2KI 2_Kings 2Kgs|
1CH 1_Chronicles 1Chr|2CH 2_Chronicles 2Chr|EZR Ezra Ezra|NEH Nehemiah Neh|EST Esther Esth|JOB Job Job|PSA Psalms Ps|PRO Proverbs Prov|ECC Ecclesiastes Eccl|SNG Song_of_Solomon Song|ISA Isaiah Isa|JER Jeremiah Jer|
LAM Lamentations Lam|EZK Ezekiel Ezek|DAN Daniel Dan|HOS Hosea Hos|JOL Joel Joel|AMO Amos Amos|OBA Obadiah Obad|JON Jonah Jonah|MIC Micah Mic|NAM Nahum Nah|HAB Habakkuk Hab|ZEP Zephaniah Zeph|HAG Haggai Hag|
ZEC Zechariah Zech|MAL Malachi Mal|MAT Matthew Matt|MRK Mark Mark|LUK Luke Luke|JHN John John|ACT Acts Acts|ROM Romans Rom|1CO 1_Corinthians 1Cor|2CO 2_Corinthians 2Cor|GAL Galatians Gal|EPH Ephesians Eph|
PHP Philippians Phil|COL Colossians Col|1TH 1_Thessalonians 1Thess|2TH 2_Thessalonians 2Thess|1TI 1_Timothy 1Tim|2TI 2_Timothy 2Tim|TIT Titus Titus|PHM Philemon Phlm|HEB Hebrews Heb|JAS James Jas|1PE 1_Peter 1Pet|
2PE 2_Peter 2Pet|1JN 1_John 1John|2JN 2_John 2John|3JN 3_John 3John|JUD Jude Jude|REV Revelation Rev
"""
ROWS = [tuple(x.split()) for x in BOOKS.replace("\n", "").split("|")]
IDS = tuple(i for i, _, _ in ROWS)
OSIS = {o: i for i, _, o in ROWS}
OLD = frozenset(IDS[:39])
# Books of one chapter; psalm numbers without a title of their own.
ONE_CHAPTER = frozenset({"OBA", "PHM", "2JN", "3JN", "JUD"})
# Abbreviations that are no beginning of the name.
IRREGULAR = {"PSA": "ps pss psalm psa", "SNG": "song,song of songs,cant,canticles", "JDG": "jdg", "EZK": "ezk", "JOL": "jol", "NAM": "nam", "MRK": "mrk mk", "LUK": "lk", "JHN": "jhn jn", "PHP": "php", "PHM": "phlm phm philem", "JAS": "jas", "MAT": "mt", "EZR": "ezr"}


def alias_key(name: str) -> str:
    return re.sub(r"\s+", " ", name.strip().rstrip(".")).lower()


def _aliases() -> dict[str, str]:
    """Names, ids, OSIS codes, the irregular forms, and the beginnings of names, from three letters, that one book alone has."""
    out: dict[str, str] = {}
    beginnings: dict[str, set[str]] = {}
    for book, name, osis in ROWS:
        name = name.replace("_", " ").lower()
        for a in (name, name.replace(" ", "") if name[0].isdigit() else name, osis.lower(), book.lower(), re.sub(r"^([1-3])", r"\1 ", osis.lower())):
            out[a] = book
        digits = 2 if name[0].isdigit() else 0
        for n in range(digits + 2, len(name)):
            beginnings.setdefault(name[:n], set()).add(book)
            if digits:
                beginnings.setdefault(name[0] + name[2:n], set()).add(book)
    for a, books in beginnings.items():
        if len(books) == 1 and a not in out and len(a.lstrip("123 ")) >= (2 if a[0].isdigit() else 3):
            out[a] = next(iter(books))
    for book, names in IRREGULAR.items():
        out |= {a: book for a in (names.split(",") if "," in names else names.split())}
    return out | {"ex": "EXO"}


ALIASES = _aliases()

# The spelling of ordinals.
_ONES = "FIRST SECOND THIRD FOURTH FIFTH SIXTH SEVENTH EIGHTH NINTH TENTH ELEVENTH TWELFTH THIRTEENTH FOURTEENTH FIFTEENTH SIXTEENTH SEVENTEENTH EIGHTEENTH NINETEENTH".split()
_TENS = "TWENTY THIRTY FORTY FIFTY SIXTY SEVENTY EIGHTY NINETY".split()


def ordinal(n: int) -> str:
    """The ordinal of 1 to 199 in letters only."""
    if n >= 100:
        return "HUNDRED" + ("TH" if n == 100 else "AND" + ordinal(n - 100))
    if n < 20:
        return _ONES[n - 1]
    tens, ones = _TENS[n // 10 - 2], n % 10
    return tens + _ONES[ones - 1] if ones else tens[:-1] + "IETH"
