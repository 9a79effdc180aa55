"""Column parsers: text cells to numbers, dates and names, as native expressions.

A malformed cell never raises: its value is null, and the rules that know what is malformed have an
error expression beside it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..vocab import SYMBOL_CURRENCIES

_BLANK = ("-", "n/a", "none", "")


def blank_to_null(c: Column) -> Column:
    """Trimmed text; null when nothing is left."""
    return F.nullif(F.trim(c), F.lit(""))


def lenient_boolean(c: Column) -> Column:
    """T/TRUE/1/Y/YES and F/FALSE/0/N/NO in any case; any other text that isn't blank is true."""
    u = F.upper(F.trim(c))
    return F.when(c.isNull(), None).when(u.isin("T", "TRUE", "1", "Y", "YES"), True).when(u.isin("F", "FALSE", "0", "N", "NO"), False).otherwise(F.length(c) > 0)


def snake_case(c: Column) -> Column:
    """Lower-case letters and digits joined by single underscores; & reads as and."""
    return F.btrim(F.regexp_replace(F.lower(F.replace(c, F.lit("&"), F.lit("and"))), "[^a-z0-9]+", "_"), F.lit("_"))


def parse_date(c: Column) -> Column:
    """A date from text: epoch milliseconds (more than 8 digits), yyyyMMdd, or text that begins with yyyy-MM-dd or yyyy/MM/dd."""
    s = F.trim(c.cast("string"))
    digits = s.rlike("^[0-9]+$")
    millis = F.timestamp_millis(F.try_to_number(s, F.lit("9" * 18)).cast("bigint")).cast("date")
    return (
        F.when(digits & (F.length(s) > 8) & (F.length(s) <= 14), millis)
        .when(digits & (F.length(s) == 8), F.try_to_timestamp(s, F.lit("yyyyMMdd")).cast("date"))
        .when(s.contains("-") & s.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}"), F.try_to_timestamp(F.substring(s, 1, 10), F.lit("yyyy-MM-dd")).cast("date"))
        .when(s.contains("/") & s.rlike("^[0-9]{4}/[0-9]{2}/[0-9]{2}"), F.try_to_timestamp(F.substring(s, 1, 10), F.lit("yyyy/MM/dd")).cast("date"))
    )


def epoch_millis_date(c: Column) -> Column:
    """The UTC date of a positive number of milliseconds."""
    return F.when(c > 0, F.timestamp_millis(c.cast("bigint")).cast("date"))


def scoped_date(scope: Column, depth: int, parent_date: Column, parent_depth: Column, snapshot: Column) -> tuple[Column, Column]:
    """A scope's own date and depth if it has one not after the snapshot, else those around it."""
    own = scope.isNotNull() & (scope <= snapshot)
    return F.when(own, scope).otherwise(parent_date), F.when(own, F.lit(depth)).otherwise(parent_depth)


def percentage(c: Column, bound: bool = False) -> Column:
    """The share that a percentage says; blanks and what is no finite number are null."""
    s = F.trim(F.replace(F.trim(c), F.lit("%"), F.lit("")))
    if bound:
        s = F.trim(F.regexp_replace(s, "^[<>~ ]+", ""))
    v = s.try_cast("double") / 100
    return F.when(~F.lower(F.trim(c)).isin(*_BLANK) & ~F.isnan(v) & (F.abs(v) < float("inf")), v)


def percentage_error(c: Column, bound: bool = False) -> Column:
    """Whether a cell that isn't blank can't be read as a number."""
    s = F.trim(F.replace(F.trim(c), F.lit("%"), F.lit("")))
    if bound:
        s = F.trim(F.regexp_replace(s, "^[<>~ ]+", ""))
    return F.coalesce(~F.lower(F.trim(c)).isin(*_BLANK) & s.try_cast("double").isNull(), F.lit(False))


#: A date inside an amount, what isn't part of a number, and a number with its unit.
_EMBEDDED_DATE = r"(\d{4}[-/]?\d{2}[-/]?\d{2}|\d{8})"
_NOT_NUMBER = "[^0-9.,kKmMbBtT]"
_NUMBER = r"([0-9]+(?:\.[0-9]+)?)\s*([kKmMbBtT]?)"
UNITS = {"": 1.0, "k": 1e3, "m": 1e6, "b": 1e9, "t": 1e12}


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def embedded_date(c: Column) -> Column:
    """The text of the first date in an amount."""
    return F.nullif(F.regexp_extract(F.trim(c), _EMBEDDED_DATE, 1), F.lit(""))


def net_assets(c: Column) -> Column:
    """An amount with k, m, b or t behind it and either mark for thousands; a date in it is left out.

    With both marks the one that comes first is for thousands; a comma alone is so when three digits
    follow the last and at most three characters precede the first.
    """

    def thousands(text: Column) -> Column:
        """The mark for thousands: the first of two kinds, or commas that part groups of three; else none."""
        comma, dot = F.instr(text, ","), F.instr(text, ".")
        groups = text.rlike("^[^,]{0,3},(.*,)?[^0-9,]*([0-9][^0-9,]*){3}$")
        return F.when((comma > 0) & (dot > 0), F.when(comma < dot, ",").otherwise(".")).when((comma > 0) & groups, ",").otherwise("")

    def number(text: Column) -> Column:
        plain = F.replace(F.replace(text, thousands(text), F.lit("")), F.lit(","), F.lit("."))
        unit = F.element_at(F.create_map(*(F.lit(x) for pair in UNITS.items() for x in pair)), F.lower(F.regexp_extract(plain, _NUMBER, 2)))
        return F.regexp_extract(plain, _NUMBER, 1).try_cast("double") * unit

    undated = _let(F.trim(c), lambda raw: F.when(raw.rlike(_EMBEDDED_DATE), F.array_join(F.split(raw, _EMBEDDED_DATE, 2), "")).otherwise(raw))
    return F.when(~F.lower(F.trim(c)).isin(*_BLANK), _let(F.regexp_replace(undated, _NOT_NUMBER, ""), number))


def amount_currency(c: Column, contract_currency: Column, known: Column) -> Column:
    """The currency of an amount: its leading token if known, the contract's if the sign may stand for it, else the contract's if known."""
    s = F.trim(c)
    token = F.upper(F.regexp_extract(s, "^([A-Za-z]{3})(?![A-Za-z])", 1))
    own = F.upper(F.trim(F.coalesce(contract_currency, F.lit(""))))
    out = F.when(s == "", None).when(token != "", F.when(F.array_contains(known, token), token))
    for sign, allowed in SYMBOL_CURRENCIES.items():
        out = out.when(F.substring(s, 1, 1) == sign, F.when(own.isin(*allowed), own))
    return F.when(c.isNotNull(), out.otherwise(F.when(F.array_contains(known, own), own)))


def tenure_start(c: Column) -> Column:
    """The date a tenure text names: yyyy/MM/dd, yyyy-MM-dd, or a year's first day."""
    s = F.trim(c)
    return (
        F.when(s.rlike("^[0-9]{4}$"), F.make_date(s.try_cast("int"), F.lit(1), F.lit(1)))
        .when(s.rlike("^[0-9]{4}/"), F.try_to_timestamp(F.substring(s, 1, 10), F.lit("yyyy/M/d")).cast("date"))
        .when(s.rlike("^[0-9]{4}-"), F.try_to_timestamp(F.substring(s, 1, 10), F.lit("yyyy-M-d")).cast("date"))
    )


def manager_tenure(c: Column, ref: Column) -> Column:
    """Years from a start date to ref, not below 0, to four places."""
    years = F.round(F.greatest(F.lit(0.0), F.datediff(ref, tenure_start(c)) / 365.25), 4)
    return F.when(~F.lower(F.trim(c)).isin(*_BLANK) & tenure_start(c).isNotNull(), years)


def tenure_error(c: Column) -> Column:
    """Whether a text that isn't blank names no start date."""
    return F.coalesce(~F.lower(F.trim(c)).isin(*_BLANK) & tenure_start(c).isNull(), F.lit(False))


def credit_label(c: Column) -> Column:
    """A credit label without its leading quality mark."""
    return F.trim(F.regexp_replace(F.trim(c), "^% Quality[/ -]", ""))


def largest_integer(c: Column) -> Column:
    """The largest whole number in a text, thousands marks allowed; 0 without one."""
    found = F.regexp_extract_all(c, F.lit(r"(\d{1,3}(?:,\d{3})+|\d+)"), F.lit(1))
    return F.coalesce(F.array_max(F.transform(found, lambda x: F.replace(x, F.lit(","), F.lit("")).try_cast("bigint"))), F.lit(0).cast("bigint"))


def finite(c: Column) -> Column:
    """Whether a number is neither null nor NaN nor infinite."""
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))


Rule = tuple[Callable[[Column], Column], Callable[[Column], Column] | None]
#: Rules of parse_columns(): the value of a cell, and whether it is malformed.
RULES: dict[str, Rule] = {
    "snake_case": (snake_case, None),
    "date": (parse_date, lambda c: blank_to_null(c).isNotNull() & parse_date(c).isNull()),
    "percentage": (percentage, percentage_error),
    "bounded_percentage": (lambda c: percentage(c, True), lambda c: percentage_error(c, True)),
    "net_assets": (net_assets, None),
    "credit_label": (credit_label, None),
    "largest_integer": (largest_integer, None),
    "boolean": (lenient_boolean, None),
    "blank_to_null": (blank_to_null, None),
}


def parse_columns(df: DataFrame, wanted: dict[str, tuple[str, str]]) -> DataFrame:
    """Adds for each output name its parsed value and <name>_error; wanted: output -> (rule, input column)."""
    out = {}
    for name, (rule, column) in wanted.items():
        value, bad = RULES[rule]
        out[name] = value(F.col(column))
        out[f"{name}_error"] = F.coalesce(bad(F.col(column)), F.lit(False)) if bad else F.lit(False)
    return df.withColumns(out)
