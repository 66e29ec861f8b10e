"""Scalar Column functions: magnitudes, times, numbers, text and JSON."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values.
AB_ZERO_POINT_NJY = 31.4
MJD_TO_JD = 2400000.5
JD_MIN, JD_MAX = 2459945.5, 2462501.5
MJD_EPOCH_DATE = "1858-11-17"
UNIX_EPOCH_MJD = 40587.0
RA_MAX = 359.99999999
THREE_LETTER_NAMES = 26 ** 3
FOUR_LETTER_END = THREE_LETTER_NAMES + 26 ** 4       # 474,552
NAMES_PER_YEAR = FOUR_LETTER_END + 26 ** 5           # five letters are our own continuation
ALPHABET = "abcdefghijklmnopqrstuvwxyz"


def is_finite(value: Column) -> Column:
    """True for a number that is neither NULL, NaN nor infinite (never NULL itself)."""
    # NaN sorts above every number, so two comparisons settle it.
    v = value.try_cast("double")
    return F.coalesce((v > float("-inf")) & (v < float("inf")), F.lit(False))


def flux_to_mag(flux: Column) -> Column:
    """nJy flux to AB magnitude, 4 decimals; NULL unless the flux is finite and positive."""
    return F.when(
        is_finite(flux) & (flux > 0), F.round(F.lit(-2.5) * F.log10(flux) + AB_ZERO_POINT_NJY, 4)
    )


def jd_to_mjd(jd: Column) -> Column:
    return jd - F.lit(MJD_TO_JD)


def mjd_to_jd(mjd: Column) -> Column:
    """MJD to the facility's JD: NULL means no constraint (0); outside its range is an error."""
    jd = mjd + F.lit(MJD_TO_JD)
    return (
        F.when(mjd.isNull(), F.lit(0.0))
        .when(jd.between(JD_MIN, JD_MAX), jd)
        .otherwise(F.raise_error(F.concat(F.lit("JD outside the facility range: "), jd.cast("string"))).cast("double"))
    )


def observing_night(mjd: Column) -> Column:
    """Night number: a night runs from noon to noon UTC."""
    return F.floor(mjd - F.lit(0.5)).cast("int")


def night_to_date(night: Column) -> Column:
    return F.date_add(F.lit(MJD_EPOCH_DATE).cast("date"), night)


def timestamp_to_mjd(ts: Column) -> Column:
    return F.unix_micros(ts) / F.lit(86400000000.0) + F.lit(UNIX_EPOCH_MJD)


def ra_wrap(ra: Column) -> Column:
    """Right ascension folded into [0, 359.99999999]."""
    return F.least(F.pmod(ra, F.lit(360.0)), F.lit(RA_MAX))


def truncate_text(text: Column, n: int) -> Column:
    return F.substring(text, 1, n)


def iso_timestamp(text: Column) -> Column:
    """ISO date or date-time text; anything unreadable is NULL."""
    return F.try_to_timestamp(text)


def format_utc(ts: Column) -> Column:
    """The timestamp form used in facility filters (session time zone UTC)."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def base26_name(index: Column) -> Column:
    """
    0..17575 as aaa..zzz, then 17576..474551 as aaaa..zzzz. Where a year needs more, five letters follow, aaaaa..zzzzz, up to
    index 12,355,927. Anything else is an error.
    """
    def letters(number: Column, width: int) -> Column:
        digits = [
            F.substring(F.lit(ALPHABET), (F.floor(number / (26 ** p)) % 26).cast("int") + 1, F.lit(1))
            for p in range(width - 1, -1, -1)
        ]
        return F.concat(*digits)

    n = index.cast("long")
    return (
        F.when((n >= 0) & (n < THREE_LETTER_NAMES), letters(n, 3))
        .when((n >= THREE_LETTER_NAMES) & (n < FOUR_LETTER_END), letters(n - THREE_LETTER_NAMES, 4))
        .when((n >= FOUR_LETTER_END) & (n < NAMES_PER_YEAR), letters(n - FOUR_LETTER_END, 5))
        .otherwise(F.raise_error(F.concat(F.lit("no name left for index "), n.cast("string"))))
    )


def parse_base26(letters: str) -> int:
    """The index behind a name's letters (a handful of characters on the driver)."""
    number = 0
    for ch in letters:
        number = number * 26 + ALPHABET.index(ch)
    return number + {4: THREE_LETTER_NAMES, 5: FOUR_LETTER_END}.get(len(letters), 0)


def payload_number(text: Column) -> Column:
    """A payload value as a finite double, else NULL. Numeric text counts, booleans do not."""
    v = text.try_cast("double")
    return F.when(is_finite(v), v)


def json_variant(text: Column) -> Column:
    """
    Parsed JSON, or NULL. Where it doesn't parse as it is, bare NaN/Infinity tokens (those followed by whole strings
    only, so outside of any) become text so that they parse and are non-finite.
    """
    bare = r'-?\b(NaN|Infinity)\b(?=(?:[^"\\]++|\\.|"(?:[^"\\]++|\\.)*+")*+$)'
    return F.coalesce(F.try_parse_json(text), F.try_parse_json(F.regexp_replace(text, bare, '"NaN"')))


def json_object(variant: Column) -> Column:
    """A JSON object as map<string, variant>; NULL when the value is no object."""
    return F.try_variant_get(variant, "$", "map<string,variant>")


def json_number(variant: Column) -> Column:
    """Number, boolean or numeric text as double; anything else NULL."""
    return F.try_variant_get(variant, "$", "double")


def merge_patch(base_json: Column, extra_json: Column) -> Column:
    """Top-level keys of `extra_json` laid over `base_json`; bad extra JSON gives NULL."""
    base = json_object(F.try_parse_json(base_json))
    extra = json_object(F.try_parse_json(extra_json))
    kept = F.map_filter(base, lambda k, _: ~F.array_contains(F.map_keys(extra), k))
    return F.to_json(F.map_concat(kept, extra))
