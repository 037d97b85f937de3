"""Normalisation of names, addresses, phones, tax codes, amounts and dates, as Column expressions."""

from __future__ import annotations

import unicodedata
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _accents() -> tuple[str, str]:
    """Precomposed letters of the Latin blocks, and what is left of each without its marks."""
    pairs = []
    for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        bare = "".join(c for c in unicodedata.normalize("NFD", chr(code)) if unicodedata.category(c) != "Mn")
        if len(bare) == 1 and bare != chr(code):
            pairs.append((chr(code), bare))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


_ACCENTED, _BARE = _accents()

# Abbreviations in addresses and what they stand for, in the order they are applied.
ABBREVIATIONS = {
    "p": "phuong",
    "q": "quan",
    "tp": "thanh pho",
    "tt": "thi tran",
    "kp": "khu pho",
    "ng": "ngo",
    "d": "duong",
    "h": "huyen",
    "sn": "so",
    "s": "so",
}


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def squeeze(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"\s+", " "))


def strip_accents(c: Column) -> Column:
    return F.regexp_replace(F.translate(c, _ACCENTED, _BARE), "[̀-ͯ]", "")


def normalize_address(c: Column) -> Column:
    """Lower case, no accents, no punctuation, abbreviations spelled out. Null stays null.

    Abbreviations are words of their own after punctuation is gone, so a
    single letter such as "s" is spelled out wherever it stands.
    """
    c = F.replace(strip_accents(F.lower(c)), F.lit("đ"), F.lit("d"))
    c = squeeze(F.regexp_replace(c, r"[.,;:/()-]+", " "))
    return squeeze(reduce(lambda x, kv: F.regexp_replace(x, rf"\b{kv[0]}\s", f"{kv[1]} "), ABBREVIATIONS.items(), c))


def phone_candidates(c: Column) -> Column:
    """Array of the valid numbers in a field: parts between / or -, of 10 or 11 digits from a 0 on."""
    digits = F.transform(F.split(c, "[/-]"), lambda x: F.regexp_replace(x, "[^0-9]", ""))
    return F.filter(digits, lambda x: x.rlike("^0[0-9]{9,10}$"))


def person_id(name: Column) -> Column:
    """Sixteen hex digits that name a person, by the normalised name."""
    return F.substring(F.sha2(normalize_address(name), 256), 1, 16)


def normalize_mst(c: Column) -> Column:
    """Digits alone, filled with zeros to ten; longer ones stay as they are; null gives ''."""
    d = F.regexp_replace(F.coalesce(c, F.lit("")), "[^0-9]", "")
    return F.when(d == "", d).when(F.length(d) < 10, F.lpad(d, 10, "0")).otherwise(d)


def is_valid_mst(c: Column) -> Column:
    return c.rlike("^[0-9]{10}$") & (c != "0000000000")


def normalize_money(c: Column) -> Column:
    """Whole currency units, cut toward zero; what isn't a number counts as 0."""
    return F.coalesce(c.try_cast("double"), F.lit(0.0)).cast("bigint")


def normalize_date(c: Column) -> Column:
    """ISO date of a spreadsheet serial (20000 to 60000), yyyy-mm-dd or dd/mm/yyyy; anything else as it is."""
    s = strip(c)
    serial = F.when(s.rlike(r"^[0-9]{5}(\.0+)?$"), s.try_cast("double").cast("int"))
    serial = F.when(serial.between(20000, 60000), F.date_format(F.date_add(F.lit("1899-12-30").cast("date"), serial), "yyyy-MM-dd"))
    iso = F.when(s.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}"), F.date_format(F.try_to_timestamp(F.substring(s, 1, 10), F.lit("yyyy-MM-dd")), "yyyy-MM-dd"))
    dmy = F.when(s.rlike("^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$"), F.date_format(F.try_to_timestamp(s, F.lit("d/M/yyyy")), "yyyy-MM-dd"))
    return F.coalesce(serial, iso, dmy, s)


def to_period(c: Column) -> Column:
    """yyyymm of 'yyyy-mm-dd'; an error for anything else, as a wrong month would be grouped unseen."""
    day = F.try_to_timestamp(strip(c), F.lit("yyyy-M-d"))
    ok = F.when(day.isNull(), F.raise_error(F.concat(F.lit("not a yyyy-mm-dd date: "), F.coalesce(c, F.lit("null"))))).otherwise(F.lit(0))
    return (ok.cast("int") + F.year(day) * 100 + F.month(day)).cast("int")


def month_index(period: Column) -> Column:
    """Months since year 0, so that neighbours in time differ by one."""
    return (F.floor(period / 100) * 12 + period % 100).cast("int")


def cutoff_date(period: int | Column, months: int) -> Column:
    """First day of the month ``months`` before a period, as an ISO string."""
    p = F.lit(period) if isinstance(period, int) else period
    return F.date_format(F.add_months(F.to_date(p.cast("string"), "yyyyMM"), -months), "yyyy-MM-dd")


def format_count(c: Column) -> Column:
    """Digits in groups of three, parted by dots."""
    return F.translate(F.format_number(c.cast("bigint"), 0), ",", ".")


def format_money(c: Column) -> Column:
    """Amounts from a million in 'tr', from a thousand million in 'ty' with one decimal after a comma."""
    billions = F.translate(F.format_number(c / 1e9, 1), ",.", ".,")
    return F.when(c >= 1e9, F.concat(billions, F.lit(" ty"))).when(c >= 1e6, F.concat(format_count(F.bround(c / 1e6)), F.lit(" tr"))).otherwise(format_count(c))
