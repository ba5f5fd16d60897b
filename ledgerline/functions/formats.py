"""Decoders and encoders for the ERP character formats, as Spark ``Column`` expressions.

All of them are built-in expressions, so they run inside whole-stage codegen; none is a UDF.
Null in gives null out unless stated otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.schemas import KEY_WIDTHS

ColumnLike = Column | str

# Fixed values of the formats.
NO_DATE = "00000000"
DATE_PATTERN = "yyyyMMdd"
TIMESTAMP_PATTERN = "yyyyMMddHHmmss"
FLAG_TRUE = "X"


def _c(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def alpha_out(c: ColumnLike) -> Column:
    """ALPHA output conversion: a purely numeric key loses its leading zeros (all zeros -> '0');
    anything else (``IC-NORTH``) is returned unchanged.

    ``\\A``/``\\z`` anchor the whole string; ``$`` would also accept a trailing newline.
    """
    c = _c(c)
    stripped = F.ltrim(c, F.lit("0"))
    return F.when(c.rlike(r"\A[0-9]+\z"), F.coalesce(F.nullif(stripped, F.lit("")), F.lit("0"))
                  ).otherwise(c)


def alpha_in(c: ColumnLike, width: int) -> Column:
    """ALPHA input conversion: zero-pad a purely numeric key to ``width``; others unchanged."""
    c = _c(c)
    return F.when(c.rlike(r"\A[0-9]+\z") & (F.length(c) <= width), F.lpad(c, width, "0")
                  ).otherwise(c)


def dats(c: ColumnLike, lenient: bool = False) -> Column:
    """DATS text ``YYYYMMDD`` -> date. ``''`` and ``00000000`` mean "no date".

    Strict by default: an invalid text raises (ANSI mode), as the source macro does. ``lenient``
    returns null for it instead, for quarantining bad rows.
    """
    c = _c(c)
    parse = F.try_to_date(c, DATE_PATTERN) if lenient else F.to_date(c, DATE_PATTERN)
    return F.when(c.isNull() | c.isin("", NO_DATE), F.lit(None).cast("date")).otherwise(parse)


def dats_encode(d: ColumnLike) -> Column:
    """date -> DATS text; null -> ``00000000``."""
    return F.coalesce(F.date_format(_c(d), DATE_PATTERN), F.lit(NO_DATE))


def number(c: ColumnLike, scale: int = 3) -> Column:
    """Number text with an optional trailing minus (``125.00-``) -> decimal(18, scale).

    Blank -> null. The suffix test looks at the untrimmed text and every trailing minus is
    stripped, as the source macro does.
    """
    c = _c(c)
    dtype = f"decimal(18,{scale})"
    trimmed = F.trim(c)
    negative = -(F.rtrim(trimmed, F.lit("-")).cast(dtype))
    return (F.when(c.isNull() | (trimmed == ""), F.lit(None).cast(dtype))
            .when(c.endswith("-"), negative)
            .otherwise(trimmed.cast(dtype)))


def amount_factor(currency_decimals: ColumnLike) -> Column:
    """Exact decimal factor 10^(2 - decimals) that turns a stored CURR amount into its value.

    Evaluated on the (tiny) currency table, never per fact row. A missing entry means 2 decimals.
    """
    d = F.coalesce(_c(currency_decimals), F.lit(2))
    return F.pow(F.lit(10), F.lit(2) - d).cast("decimal(22,12)")


def amount(stored: ColumnLike, factor: ColumnLike) -> Column:
    """Stored CURR text -> true amount decimal(18,3): ``number(stored) * factor``.

    ``factor`` comes from ``amount_factor`` (null = currency without an entry = factor 1).
    """
    f = F.coalesce(_c(factor), F.lit(1).cast("decimal(22,12)"))
    return (number(stored) * f).cast("decimal(18,3)")


def amount_encode(value: ColumnLike, factor: ColumnLike) -> Column:
    """True amount -> stored CURR text: value / factor rounded half-up to 2 places, absolute
    value printed with 2 decimals and a trailing minus for negatives."""
    f = F.coalesce(_c(factor), F.lit(1).cast("decimal(22,12)"))
    internal = F.round(_c(value).cast("decimal(38,12)") / f, 2).cast("decimal(20,2)")
    text = F.abs(internal).cast("string")
    return F.when(internal < 0, F.concat(text, F.lit("-"))).otherwise(text)


MAX_PRICE_DECIMALS = 8


def price_in(eur_price: ColumnLike, units_per_eur: ColumnLike, currency_decimals: ColumnLike
             ) -> Column:
    """EUR price converted into a currency, rounded half-up to that currency's decimals
    (``currency_decimals`` null = 2). Returns decimal(28,8), which holds 0-8 decimals; a currency
    with more raises an error."""
    product = _c(eur_price).cast("decimal(18,6)") * _c(units_per_eur).cast("decimal(18,6)")
    d = F.coalesce(_c(currency_decimals), F.lit(2))
    # F.round needs a literal scale: one branch per number of decimals
    price = F.when(d == 0, F.round(product, 0).cast("decimal(28,8)"))
    for scale in range(1, MAX_PRICE_DECIMALS + 1):
        price = price.when(d == scale, F.round(product, scale).cast("decimal(28,8)"))
    return price.otherwise(F.raise_error(F.concat(F.lit("no price has this many decimals: "), d.cast("string")))
                           .cast("decimal(28,8)"))


def timestamp_of(date_text: ColumnLike, time_text: ColumnLike) -> Column:
    """``YYYYMMDD`` || ``HHMMSS`` -> timestamp without time zone (null if either is null)."""
    return F.to_timestamp_ntz(F.concat(_c(date_text), _c(time_text)), F.lit(TIMESTAMP_PATTERN))


def flag(c: ColumnLike) -> Column:
    """``'X'`` = true; null stays null."""
    return _c(c) == F.lit(FLAG_TRUE)


def tabkey_encode(key_columns: dict[str, ColumnLike] | list[str]) -> Column:
    """Concatenate key fields left-justified to their fixed widths (the change log's TABKEY).

    A value longer than its width is kept whole (``rpad`` alone would truncate it).
    """
    if isinstance(key_columns, list):
        key_columns = {k: k for k in key_columns}
    parts = []
    for name, c in key_columns.items():
        c, width = _c(c), KEY_WIDTHS[name]
        parts.append(F.when(F.length(c) > width, c).otherwise(F.rpad(c, width, " ")))
    return F.concat(*parts)


def tabkey_decode(tabkey: ColumnLike, keys: list[str] | tuple[str, ...]) -> dict[str, Column]:
    """Split a TABKEY into right-trimmed fixed-width slices, one column per key field."""
    out, pos = {}, 1
    for name in keys:
        width = KEY_WIDTHS[name]
        out[name] = F.rtrim(F.substring(_c(tabkey), pos, width))
        pos += width
    return out
