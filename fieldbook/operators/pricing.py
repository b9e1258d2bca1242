"""Commission: agreements in force on the admission date, and what they make payable."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook import vocabulary as v
from fieldbook.functions.clock import parse_time
from fieldbook.functions.text import MONEY, joined_key, money, percent, pick

AMOUNT = "decimal(18,4)"
DEFAULT_TAX = "0.18"


def lender_category(lender: Column, roles: v.Roles = v.ROLES) -> Column:
    return (
        F.when(lender.isNull(), v.NO_LENDER)
        .otherwise(F.coalesce(pick(lender, dict(roles.lender_categories)), F.lit(v.OTHER_LENDER)))
    )


def with_tax(share: Column, tax_rate: str = DEFAULT_TAX) -> Column:
    return (share * F.lit(tax_rate).cast("decimal(6,4)") + share).cast("decimal(18,6)")


def charge_basis(remarks: Column, approved: Column, total_bill: Column) -> Column:
    """The amount a share applies to; the remark is compared without regard to case."""
    basis = F.lower(F.trim(remarks))
    return F.when(basis == v.ON_APPROVED, approved).when(basis == v.ON_TOTAL_BILL, total_bill)


def net_payable(
    approved: Column, total_share: Column, withheld: Column, discount: Column, other: Column
) -> Column:
    return (approved - total_share - withheld + discount + other).cast(AMOUNT)


# Bins of four sizes, each eight times the one before: 32, 256, 2048 and 16384 days.
BIN_DAYS, WIDER, LEVELS = 32, 8, 4
# Days since 1970 that bins are made for; earlier and later ones share the first and the last bin.
FIRST_DAY, LAST_DAY = -25_567, 47_482  # 1900-01-01, 2100-01-01
ANY_DAY = -(2**31)


def in_force(
    cases: DataFrame,
    rates: DataFrame,
    *,
    key: str,
    on_date: Column,
    start: str = "start_date",
    end: str = "end_date",
) -> DataFrame:
    """Left join to the agreements, without those that are *known* to be outside their period.

    A case whose agreements all miss the date disappears, while a case without agreement, without
    date or with an open-ended agreement stays. A case meets only the agreements of its key whose period touches its
    bin (a case without date all of them), however many the key has. An agreement has bins of one size, the largest that is
    not longer than its period, and a case looks up the sizes that its key has. Both joins shuffle: Spark takes an agreement
    with its bins for one row, so it would send to the driver what its threshold is meant to keep from it.
    """
    sizes = rates.where(F.col(key).isNotNull()).groupBy(key).agg(F.collect_set(_level(*_days(start, end))).alias("_levels"))
    met = binned(rates, key, start, end).withColumn("_met", F.lit(True))
    rows = cases.withColumn("_on", on_date).join(sizes.hint("merge"), key, "left")
    day = F.unix_date(F.col("_on").cast("date"))
    levels = F.coalesce(F.col("_levels"), F.array(F.lit(0)))  # a key without agreements: any bin, so that such rows spread
    bins = F.when(day.isNull(), F.array(F.lit(ANY_DAY))).otherwise(F.transform(levels, lambda n: _bin(_number(day, n), n)))
    rows = rows.withColumn("_bin", F.explode(bins)).join(met.hint("merge"), [key, "_bin"], "left")
    outside = F.coalesce((F.col("_on") < F.col(start)) | (F.col("_on") > F.col(end)), F.lit(False))
    kept = rows.where(F.col("_levels").isNull() | (F.col("_met").isNotNull() & ~outside))
    return kept.select(key, *[c for c in cases.columns if c != key], *[c for c in rates.columns if c != key])


def binned(rates: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """Each agreement once for every bin of its size that its period touches, nine at most, and once for cases without a date."""
    first, last = _days(start, end)
    level = _level(first, last)
    low, high = _number(first, level), _number(last, level)
    touched = F.transform(F.sequence(low, high), lambda number: _bin(number, level))
    bins = F.when(low <= high, touched).otherwise(F.array().cast("array<int>"))
    return rates.where(F.col(key).isNotNull()).withColumn("_bin", F.explode(F.concat(F.array(F.lit(ANY_DAY)), bins)))


def _days(start: str, end: str) -> tuple[Column, Column]:
    """First and last day of a period; an open one reaches to the end of the bins."""
    return (
        _inside(F.coalesce(F.unix_date(F.col(start).cast("date")), F.lit(FIRST_DAY))),
        _inside(F.coalesce(F.unix_date(F.col(end).cast("date")), F.lit(LAST_DAY))),
    )


def _inside(day: Column) -> Column:
    return F.greatest(F.lit(FIRST_DAY), F.least(F.lit(LAST_DAY), day))


def _level(first: Column, last: Column) -> Column:
    longer = [(last - first >= BIN_DAYS * WIDER**n).cast("int") for n in range(1, LEVELS)]
    return sum(longer, F.lit(0))


def _number(day: Column, level: Column) -> Column:
    """Which bin of the level's size a day is in."""
    return F.floor(_inside(day) / (BIN_DAYS * F.pow(F.lit(WIDER), level))).cast("int")


def _bin(number: Column, level: Column) -> Column:
    """One number for a bin among those of all sizes."""
    return number * LEVELS + level


def statement_label(lender: Column, admission: Column, start: Column, end: Column) -> Column:
    """Later rules win, hence the reversed order: lender, then admission date, then period."""
    return (
        F.when(lender.isNull(), v.LENDER_MISSING)
        .when(admission.isNull(), v.ADMISSION_MISSING)
        .when((admission >= start) & (admission <= end), v.COMMISSION_DONE)
    )


def parse_rates(sheet: DataFrame) -> DataFrame:
    """key, share_pct, net_share_pct, remarks, start_date, end_date (all text) → typed."""
    return sheet.select(
        "key",
        percent(F.col("share_pct")).alias("share"),
        percent(F.col("net_share_pct")).alias("net_share"),
        "remarks",
        parse_time(F.col("start_date")).alias("start_date"),
        parse_time(F.col("end_date")).alias("end_date"),
    )


def price_cases(cases: DataFrame, rates: DataFrame, roles: v.Roles = v.ROLES) -> DataFrame:
    """Cases with the share, tax and net payable of the agreement in force.

    cases: hospital_name, source, lender_name, admission_date, case_created_on,
    approved (money), total_bill (money) and anything else, which is passed through.
    """
    keyed = cases.withColumn("category", lender_category(F.col("lender_name"), roles)).withColumn(
        "key", joined_key(F.col("hospital_name"), F.col("source"), F.col("category"))
    )
    effective = F.coalesce(F.col("admission_date"), F.col("case_created_on"))
    priced = in_force(keyed, parse_rates(rates), key="key", on_date=effective)
    zero = F.lit(0).cast(MONEY)
    basis = charge_basis(F.col("remarks"), F.col("approved"), F.col("total_bill"))
    return (
        priced.withColumn("share_amount", (basis * F.col("share")).cast(AMOUNT))
        .withColumn("total_share", (basis * F.col("net_share")).cast(AMOUNT))
        .withColumn("withheld", zero)
        .withColumn("discount", zero)
        .withColumn("other_collected", zero)
        .withColumn("tax_amount", (F.col("total_share") - F.col("share_amount")).cast(AMOUNT))
        .withColumn(
            "net_payable",
            net_payable(F.col("approved"), F.col("total_share"), zero, zero, zero),
        )
        .withColumn(
            "statement_note",
            statement_label(
                F.col("lender_name"), F.col("admission_date"), F.col("start_date"), F.col("end_date")
            ),
        )
        .drop("key", "start_date", "end_date")
    )


def price_sheet(sheet: DataFrame, tax_rate: str = DEFAULT_TAX) -> DataFrame:
    """Text sheet of earlier cases: same measures, with the share given per row."""
    share = percent(F.col("share_pct"))
    typed = sheet.select(
        *[c for c in sheet.columns if c not in
          ("approved", "total_bill", "discount", "other_collected", "withheld", "share", "share_pct")],
        *[money(F.col(c)).alias(c) for c in
          ("approved", "total_bill", "discount", "other_collected", "withheld")],
        money(F.col("share")).alias("share_amount"),
        share.alias("share"),
        with_tax(share, tax_rate).alias("net_share"),
    )
    basis = charge_basis(F.col("remarks"), F.col("approved"), F.col("total_bill"))
    total = (basis * F.col("net_share")).cast(AMOUNT)
    return (
        typed.withColumn("total_share", total)
        .withColumn("tax_amount", (F.col("total_share") - F.col("share_amount")).cast(AMOUNT))
        .withColumn(
            "net_payable",
            net_payable(
                F.col("approved"), F.col("total_share"), F.col("withheld"),
                F.col("discount"), F.col("other_collected"),
            ),
        )
    )
