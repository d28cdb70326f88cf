"""Column rules for text dates, tax ids, money, sizes and labels. All conversions of dirty text give null, not errors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Width of a unit in sizes as collectors print them: K is 1024 whether written KB or KiB.
_UNITS = {"": 0, "K": 1, "M": 2, "G": 3, "T": 4, "P": 5}


def iso_day_text(c: Column) -> Column:
    """DD/MM/YYYY becomes YYYY-MM-DD, an ISO date with a time keeps its first ten letters, other text stays."""
    br = c.rlike(r"^\d{2}/\d{2}/\d{4}$")
    turned = F.concat_ws("-", F.substring(c, 7, 4), F.substring(c, 4, 2), F.substring(c, 1, 2))
    return F.when(br, turned).when(c.rlike(r"^\d{4}-\d{2}-\d{2}[T ]"), F.substring(c, 1, 10)).otherwise(c)


def as_day(c: Column) -> Column:
    """Date of a text that ``iso_day_text`` brings to YYYY-MM-DD; null where that is no date."""
    t = iso_day_text(c)
    return F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(t, "yyyy-MM-dd"))


def br_day_text(d: Column) -> Column:
    """Date as DD/MM/YYYY."""
    return F.date_format(d, "dd/MM/yyyy")


def first_digits(*cols: Column) -> Column:
    """Digits of the first column that isn't null or empty; null where none is."""
    first = F.coalesce(*[F.when(F.trim(c) != "", c) for c in cols])
    return F.regexp_replace(first, "[^0-9]", "")


def taxpayer_kind(digits: Column) -> Column:
    """PF for 11 digits, PJ for 14, INVALIDO for others; null stays null."""
    return F.when(F.length(digits) == 11, "PF").when(F.length(digits) == 14, "PJ").when(digits.isNotNull(), "INVALIDO")


def year_month(day_text: Column) -> tuple[Column, Column]:
    """(year, month) of a text that starts as YYYY-MM; null where the letters are no numbers."""
    return F.substring(day_text, 1, 4).try_cast("int"), F.substring(day_text, 6, 2).try_cast("int")


def money(c: Column) -> Column:
    """decimal(15,2); null where the text is no number or too large."""
    return c.try_cast("decimal(15,2)")


def size_bytes(c: Column) -> Column:
    """Bytes of a size such as 512MiB or 2GB, base 1024; an unknown unit counts as bytes, no number gives 0."""
    number = F.regexp_extract(c, r"^\s*([0-9]+(?:\.[0-9]+)?)", 1)
    unit = F.upper(F.regexp_extract(c, r"^\s*[0-9.]+\s*([KMGTPkmgtp]?)i?[Bb]?\s*$", 1))
    factor = F.lit(1)
    for u, p in _UNITS.items():
        if u:
            factor = F.when(unit == u, F.lit(1024**p)).otherwise(factor)
    return F.when(number != "", F.floor(number.try_cast("double") * factor).cast("bigint")).otherwise(F.lit(0).cast("bigint"))


def percent(c: Column) -> Column:
    """Number of a text with a percent sign; empty gives 0, text that is no number is an error."""
    t = F.rtrim(F.regexp_replace(F.trim(c), "%$", ""))
    return F.when(t == "", F.lit(0.0)).otherwise(t.cast("double"))


def audit_time(c: Column) -> Column:
    """``MM/DD/YY hh:mm:ss.mmm`` as ``20YY-MM-DD hh:mm:ss.mmm``; other text stays."""
    return F.regexp_replace(c, r"^(\d{2})/(\d{2})/(\d{2}) ", "20$3-$1-$2 ")


#: Pattern of an amount in reais within a text.
AMOUNT = r"R\$\s?([0-9]{1,3}(?:\.[0-9]{3})*(?:,[0-9]{1,2})?|[0-9]+(?:,[0-9]{1,2})?)"


def amounts(text: Column) -> Column:
    """All amounts in reais of a text as array<double>."""
    found = F.regexp_extract_all(text, F.lit(AMOUNT), 1)
    return F.transform(found, lambda x: F.replace(F.replace(x, F.lit("."), F.lit("")), F.lit(","), F.lit(".")).try_cast("double"))


def unsupported(found: Column, allowed: Column, tolerance: float = 0.005) -> Column:
    """Numbers of ``found`` that are not within ``tolerance`` (of the larger of |allowed| and 1) of an allowed one."""
    return F.filter(found, lambda v: ~F.exists(allowed, lambda p: F.abs(v - p) <= F.lit(tolerance) * F.greatest(F.abs(p), F.lit(1.0))))


def reais(c: Column) -> Column:
    """Fixed format ``R$ 1.234,56``; null reads ``não informado``."""
    text = F.translate(F.format_number(c.cast("double"), 2), ",.", ".,")
    return F.when(c.isNull(), "não informado").otherwise(F.concat(F.lit("R$ "), text))


def reais_scaled(c: Column) -> Column:
    """Amount in bi, mi or mil with its sign, as read on a card; null reads ``não informado``."""
    v = c.cast("double")
    a = F.abs(v)
    sign = F.when(v < 0, "-").otherwise("")
    f = lambda x, n: F.translate(F.format_number(x, n), ",.", ".,")
    body = F.when(a >= 1e9, F.concat(f(a / 1e9, 2), F.lit(" bi"))).when(a >= 1e6, F.concat(f(a / 1e6, 2), F.lit(" mi"))).when(a >= 1e3, F.concat(f(a / 1e3, 1), F.lit(" mil"))).otherwise(f(a, 2))
    return F.when(c.isNull(), "não informado").otherwise(F.concat(F.lit("R$ "), sign, body))


def risk_class(score: Column) -> Column:
    """Baixo below 0.70, Médio up to 0.85, Alto above; null stays null."""
    return F.when(score < 0.70, "Baixo").when(score <= 0.85, "Médio").when(score.isNotNull(), "Alto")


def yes_no(c: Column) -> Column:
    """Sim or Não; null reads as Não."""
    return F.when(F.coalesce(c, F.lit(False)), "Sim").otherwise("Não")


def month_label(year: Column, month: Column) -> Column:
    """``YYYY-MM``."""
    return F.concat_ws("-", year.cast("string"), F.lpad(month.cast("string"), 2, "0"))


def quarter_label(year: Column, quarter: Column) -> Column:
    """``YYYY-Tn``."""
    return F.concat(year.cast("string"), F.lit("-T"), quarter.cast("string"))


def quarter_bounds(year: Column, quarter: Column) -> tuple[Column, Column]:
    """First and last day of a quarter."""
    first = F.make_date(year, (quarter - 1) * 3 + 1, F.lit(1))
    return first, F.date_sub(F.add_months(first, 3), 1)


def next_quarter(year: Column, quarter: Column) -> tuple[Column, Column]:
    """The quarter after, by the calendar."""
    return F.when(quarter == 4, year + 1).otherwise(year), F.when(quarter == 4, 1).otherwise(quarter + 1)


def election_flag(year: Column, quarter: Column) -> Column:
    """1 where the quarter after lies in an even year, else 0."""
    return F.when(next_quarter(year, quarter)[0] % 2 == 0, 1).otherwise(0)


def markdown_safe(c: Column) -> Column:
    """``$`` escaped, so that a renderer doesn't take amounts for formulas."""
    return F.replace(c, F.lit("$"), F.lit("\\$"))
