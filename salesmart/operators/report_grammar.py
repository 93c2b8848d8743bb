"""The yearly category report by a block grammar.

A report is a list of lines: a label cell and one cell for each of fifteen
periods.  The grammar says which blocks there are, how many lines each has, what
each line measures and in which unit; one parser reads the category blocks and
the KPI blocks below them.  A label stands on the first line of its block only
and may be damaged: broken over lines, spaced, in small letters, with arrows for
"up" and "down".  ``clean_label`` undoes that; the dictionary of labels then says
which item it names, by its whole text or, for KPI, by its first words.

Lines that the grammar can't place are listed with a reason: a label that the
dictionary lacks, lines beyond the end of a block, lines before any label, and
cells that hold no number.  Nothing is dropped without a word.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.functions.text import parse_amount
from salesmart.operators.reports_block import CATEGORY_ORDER, METRICS, PERIODS, period_label, period_of

# Units of the measures and the decimals that a report prints
MONEY, PERCENT, COUNT, RATIO = "money", "percent", "count", "ratio"
DECIMALS = {MONEY: 2, PERCENT: 1, COUNT: 0, RATIO: 2}


@dataclass(frozen=True)
class Block:
    """An item's lines in order, as (measure, unit), and the labels that name it:
    whole ones, or those that a label may begin with."""
    item: str
    kind: str
    lines: tuple[tuple[str, str], ...]
    labels: tuple[str, ...]
    prefix: bool = False


_CATEGORY_LINES = tuple(zip(METRICS, (MONEY, PERCENT, PERCENT, PERCENT)))
# Labels that differ from their item's code, and the KPI blocks at the report's foot
_OTHER_LABELS = {"FB": ("F&B", "F & B", "FOOD AND BEVERAGE"), "GRAM_COOKIES": ("GRAM COOKIE",), "OTHER": ("OTHERS",)}
KPI_BLOCKS = (
    Block("CUSTOMER_COUNT", "kpi", (("customer_count", COUNT), ("customer_yoy_pct", PERCENT)), ("CUSTOMER",), True),
    Block("UNIT_PRICE", "kpi", (("unit_price", MONEY), ("unit_price_yoy_pct", PERCENT)), ("CUS UNIT", "UNIT PRICE"), True),
    Block("TURNOVER", "kpi", (("turnover_curr", RATIO), ("turnover_prev", RATIO)), ("TURNOVER",), True),
    Block("DAY_IN_MONTH", "kpi", (("day_in_month_curr", COUNT), ("day_in_month_prev", COUNT)), ("DAY IN",), True),
    Block("AVERAGE_DAILY_SALES", "kpi", (("avg_daily_sales", MONEY), ("avg_daily_sales_yoy_pct", PERCENT)), ("AVERAGE",), True),
)
GRAMMAR = tuple(Block(c, "category", _CATEGORY_LINES, (c.replace("_", " "), *_OTHER_LABELS.get(c, ()))) for c in CATEGORY_ORDER) \
    + KPI_BLOCKS


def clean_label(label: Column) -> Column:
    """Capital letters, arrows as words, any white space as one blank."""
    s = F.regexp_replace(F.regexp_replace(F.upper(label), "[↓▼⇩]", " DOWN "), "[↑▲⇧]", " UP ")
    return F.trim(F.regexp_replace(s, r"[\s 　]+", " "))


def item_of(label: Column, grammar=GRAMMAR) -> Column:
    """The item that a cleaned label names, or NULL."""
    whole = [x for b in grammar if not b.prefix for own in b.labels for x in (F.lit(own), F.lit(b.item))]
    expr = F.create_map(*whole)[label] if whole else F.lit(None).cast("string")
    for b in grammar:
        for start in b.labels if b.prefix else ():
            expr = F.coalesce(expr, F.when(label.startswith(start), F.lit(b.item)))
    return expr


def _line_of(item: Column, offset: Column, grammar) -> Column:
    """(kind, measure, unit) of the block's line at ``offset``, or NULL beyond its end."""
    shape = F.create_map(*[x for b in grammar for x in (F.lit(b.item), F.array(*[
        F.struct(F.lit(b.kind).alias("kind"), F.lit(m).alias("measure"), F.lit(u).alias("unit")) for m, u in b.lines]))])
    return F.get(shape[item], offset)


def _placed(lines: DataFrame, grammar) -> DataFrame:
    """Lines with their block's cleaned label, item, offset in it and meaning."""
    label = clean_label(F.get("cells", 0))
    own = F.when(label != "", label)
    report = Window.partitionBy("report_year").orderBy("pos")       # one report: some 70 lines
    upto = report.rowsBetween(Window.unboundedPreceding, 0)
    r = lines.select("report_year", "pos", "cells", F.last(F.when(own.isNotNull(), F.struct(own.alias("label"), F.col("pos").alias("at"))),
                                                           ignorenulls=True).over(upto).alias("head"))
    r = r.select("report_year", "pos", "cells", "head.label", (F.col("pos") - F.col("head.at")).alias("offset"))
    r = r.withColumn("item", item_of(F.col("label"), grammar))
    return r.withColumn("line", _line_of(F.col("item"), F.col("offset"), grammar))


def parse_report(lines: DataFrame, grammar=GRAMMAR) -> DataFrame:
    """(report_year, kind, item, measure, period_type, report_month, value) of every
    number in lines (report_year, pos, cells)."""
    r = _placed(lines, grammar).where(F.col("line").isNotNull())
    r = r.select("report_year", "item", "line.*", F.posexplode(F.slice("cells", 2, len(PERIODS))).alias("p", "text"))
    period, month = period_of(F.col("p"))
    return r.select("report_year", "kind", "item", "measure", period.alias("period_type"), month.alias("report_month"),
                    parse_amount("text").alias("value")).where(F.col("value").isNotNull())


def unplaced_lines(lines: DataFrame, grammar=GRAMMAR) -> DataFrame:
    """(report_year, pos, label, reason) of the lines that no block takes, and of
    those that hold text which is neither a number nor a mark for none."""
    r = _placed(lines, grammar)
    empty = F.array(*[F.lit(x) for x in ("", "-", "N/A", "#N/A")])
    odd = F.exists(F.slice("cells", 2, len(PERIODS)),
                   lambda x: x.isNotNull() & ~F.array_contains(empty, F.trim(x)) & parse_amount(x).isNull())
    reason = (F.when(F.col("label").isNull(), "no label above").when(F.col("item").isNull(), "unknown label")
              .when(F.col("line").isNull(), "beyond its block").when(odd, "no number"))
    return r.select("report_year", "pos", "label", reason.alias("reason")).where(F.col("reason").isNotNull())


def kpi_table(long: DataFrame, grammar=GRAMMAR) -> DataFrame:
    """One row per (year, period) with all KPI measures."""
    names = [m for b in grammar if b.kind == "kpi" for m, _ in b.lines]
    return (long.where("kind = 'kpi'").groupBy("report_year", "period_type", "report_month")
            .agg(*[F.max(F.when(F.col("measure") == m, F.col("value"))).alias(m) for m in names]))


def category_table(long: DataFrame) -> DataFrame:
    """One row per (year, period, category) with the four metrics."""
    return (long.where("kind = 'category'").groupBy("report_year", "report_month", "period_type", F.col("item").alias("category"))
            .agg(*[F.max(F.when(F.col("measure") == m, F.col("value"))).alias(m) for m in METRICS]))


def render_report(values: DataFrame, damage: Column | None = None, grammar=GRAMMAR) -> DataFrame:
    """Lines (report_year, pos, cells) of values (report_year, item, measure,
    period_type, report_month, value): the blocks in the grammar's order, every
    line of a block that has any value.  ``damage`` rewrites the labels; it may
    read report_year, item and ``label``."""
    order = F.create_map(*[x for i, b in enumerate(grammar) for x in (F.lit(b.item), F.lit(i))])
    first = F.create_map(*[x for b in grammar for x in (F.lit(b.item), F.lit(b.labels[0]))])
    periods = [p for p, _, _ in PERIODS]
    wide = (values.withColumn("period", period_label(F.col("period_type"), F.col("report_month")))
            .groupBy("report_year", "item", "measure").pivot("period", periods).agg(F.first("value")))
    decimals = F.create_map(*[x for m, u in dict.fromkeys(line for b in grammar for line in b.lines) for x in (F.lit(m), F.lit(DECIMALS[u]))])

    def printed(v: Column) -> Column:
        body = F.call_function("format_number", F.abs(v), F.col("decimals"))
        return F.when(v.isNull(), "-").when(v < 0, F.concat(F.lit("("), body, F.lit(")"))).otherwise(body)
    rows = wide.withColumn("decimals", decimals[F.col("measure")]).select(
        "report_year", "item", "measure", F.transform(F.array(*periods), printed).alias("cells"))
    at = F.create_map(*[x for b in grammar for i, (m, _) in enumerate(b.lines) for x in (F.lit(f"{b.item}|{m}"), F.lit(i))])
    rows = rows.withColumn("offset", at[F.concat_ws("|", "item", "measure")]).withColumn("label", first[F.col("item")])
    longest = max(len(b.lines) for b in grammar)
    label = F.when(F.col("offset") == 0, F.col("label") if damage is None else damage).otherwise(F.lit(""))
    return rows.select("report_year", (order[F.col("item")] * longest + F.col("offset")).alias("pos"),
                       F.concat(F.array(label), F.col("cells")).alias("cells"))
