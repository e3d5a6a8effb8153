"""Many cut-off dates in one job: a per-depot timeline of the days on which something changes.

Between two such days every measure of a depot is constant, so it is computed
once per *period* (``Periods``: first day, day after the last, values), not
once per date. Rows of all sources are stacked, partitioned by depot and
ordered by epoch day; every measure is read from a frame ``UNBOUNDED PRECEDING
.. CURRENT ROW``, which Spark evaluates incrementally (O(1) per row). The
dates come in last: ``Periods.per_day`` lays the calendar over the periods, without a shuffle, and only what depends on the date itself (days
since ...) is computed for each of its rows.

* Day windows (30 / 90 days) use add-and-expire rows: an event adds its
  count/amount on its day and an *expiry* row subtracts it on day + 31
  (or + 91). The running sum is then exactly the window sum. Amounts are
  integer 1/10000 units, so the subtraction is exact.
* "Last value on or before the date" (last trade, last buy, last cash flow,
  position snapshot, balance) is a running max / ``last(ignorenulls)``.
* Distinct order months up to the date: +1 on the first order day of every
  month.
* Months with a day in the last six months (active months, savings-plan
  strength) add 1 on the month's first such day and expire when its last one
  has left the window; savings-plan months expire after four calendar months.
* Monthly deposit volatility changes on deposit days and 181 days after them.
  Per (depot, month) its deposit days are kept, each such list is copied to the
  six following months, and every change day of a month is evaluated over the
  at most seven small lists with array functions.

* Orders that are known later than their own day (late file deliveries) enter
  at the day they are known from and expire by their own day; what was known
  too late for a window never enters it.

Per depot the timeline holds at most a few rows per day, however many raw
rows the depot has, so a very large depot does not make a large partition.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depotlens import params as P
from depotlens.functions.columns import epoch_day, month_index
from depotlens.operators import balances as BAL
from depotlens.operators import bookings as BK
from depotlens.operators import orders as OR
from depotlens.operators import positions as POS

_DAY0 = "1970-01-01"


def _unit0() -> Column:
    return F.lit(0).cast("bigint")


def as_day(e: Column) -> Column:
    """The date of an epoch day."""
    return F.date_add(F.lit(_DAY0).cast("date"), e)


def _int_array(values: list[int]) -> Column:
    """A constant array (folded to one literal by the optimizer)."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<int>") if values else F.lit(None).cast("array<int>")


def first_of_month_epoch(m: Column) -> Column:
    """Epoch day of the first day of month index ``m`` (year*12 + month-1)."""
    return epoch_day(F.make_date(F.floor(m / 12).cast("int"), (m % 12 + 1).cast("int"), F.lit(1)))


def _leaves_six_months(d: Column) -> Column:
    """The first epoch day whose date six months back lies after ``d``'s day, or in a later month."""
    whole_month = first_of_month_epoch(month_index(d) + 7)
    return F.when(d == F.last_day(d), whole_month).otherwise(epoch_day(F.add_months(d, 6)) + 1)


@dataclass(frozen=True)
class Periods:
    """Values per depot that hold from epoch day ``e`` until the day before
    ``until`` (NULL: from then on), and the calendar (column ``as_of``) they
    are wanted for. A depot's periods do not overlap.

    The calendar has a row per day at most, so its size is bounded by the span
    of days it covers; it is collected once and sent to all tasks, the depot
    side never is.
    """

    rows: DataFrame
    dates: DataFrame

    @property
    def columns(self) -> list[str]:
        return [c for c in self.rows.columns if c not in ("e", "until")]

    def select(self, *columns) -> Periods:
        return Periods(self.rows.select("e", "until", *columns), self.dates)

    def between(self, first, last) -> Periods:
        """The same periods for the calendar dates from ``first`` to ``last`` (both included) only."""
        day = F.col("as_of")
        return Periods(self.rows, self.dates.where(day.between(F.lit(str(first)).cast("date"), F.lit(str(last)).cast("date"))))

    @cached_property
    def _days(self) -> list[int]:
        """The calendar as epoch days, in order."""
        return sorted(r[0] for r in self.dates.select(epoch_day("as_of")).where(F.col("as_of").isNotNull()).collect())

    def _span(self) -> tuple[Column, Column]:
        """First and last day of the calendar (NULL if it is empty)."""
        return tuple(F.lit(d).cast("int") for d in ((self._days[0], self._days[-1]) if self._days else (None, None)))

    def _covered(self) -> tuple[Column, Column]:
        """Per period: the number of calendar dates before it, and of those in it (NULL or 0 without one)."""
        lo, hi = self._span()
        table = _int_array([bisect_left(self._days, d) for d in range(self._days[0], self._days[-1] + 2)] if self._days else [])
        first, end = F.greatest(F.col("e"), lo), F.least(F.col("until"), hi + 1)
        start = F.get(table, first - lo)
        return start, F.when(F.col("e").isNotNull() & (first < end), F.get(table, end - lo) - start)

    def per_day(self, date_col: str = "Score_Datum") -> DataFrame:
        """One row per period and calendar date in it."""
        key, *rest = self.columns
        daily = self.with_days("_days").select(*self.columns, F.explode("_days").alias("_day"))
        return daily.select(key, as_day(F.col("_day")).alias(date_col), *rest)

    def per_day_by_date(self, date_col: str = "Score_Datum", run_days: int = 8, rows_per_task: int = 20_000_000) -> DataFrame:
        """``per_day`` with the rows of a date in few tasks, for tables laid out by date.

        What is shuffled are the periods, once for each run of ``run_days``
        calendar dates that they reach into, not the rows. A run with many rows
        is dealt out by key.
        """
        key, *rest = self.columns
        start, n = self._covered()
        held = self.rows.select(*self.rows.columns, start.alias("_start"), n.alias("_n")).where(F.col("_n") > 0)
        runs = max(1, -(-len(self._days) // run_days))
        parts = max(1, -(-(held.agg(F.sum("_n")).first()[0] or 0) // (runs * rows_per_task)))
        run = F.floor(F.col("_start") / run_days), F.floor((F.col("_start") + F.col("_n") - 1) / run_days)
        spread = held.select(*self.columns, "_start", "_n", F.explode(F.sequence(*run)).alias("_run"))
        place = F.col("_run") * parts + F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(parts))
        spread = spread.repartitionById(runs * parts, place.cast("int"))
        first, end = F.greatest("_start", F.col("_run") * run_days), F.least(F.col("_start") + F.col("_n"), (F.col("_run") + 1) * run_days)
        daily = spread.select(*self.columns, F.explode(F.slice(_int_array(self._days), (first + 1).cast("int"), (end - first).cast("int"))).alias("_day"))
        return daily.select(key, as_day(F.col("_day")).alias(date_col), *rest)

    def with_days(self, out: str) -> DataFrame:
        """The periods that hold a calendar date, with the array of the epoch days they hold."""
        start, n = self._covered()
        placed = self.rows.select(*self.rows.columns, start.alias("_start"), n.alias("_n")).where(F.col("_n") > 0)
        return placed.select(*self.rows.columns, F.slice(_int_array(self._days), F.col("_start") + 1, F.col("_n")).alias(out))

    def weighted(self, out: str = "n_days") -> DataFrame:
        """The periods that hold a calendar date, with the number of those they hold."""
        return self.rows.withColumn(out, self._covered()[1].cast("bigint")).where(F.col(out) > 0)

    def sums_per_day(self, groups: list[str], sums: dict[str, Column], date_col: str = "Score_Datum") -> DataFrame:
        """Per group and calendar date that has a period: the number of its periods (``n``) and their ``sums`` (of finite values without NULL).

        A period adds its values on its first day and takes them back after its
        last, so its days are not counted out; the running sums have a row per
        group and day with a change. The key column is not kept.
        """
        lo, hi = self._span()
        first, end = F.greatest(F.col("e"), lo), F.least(F.col("until"), hi + 1)
        values = {"n": F.lit(1).cast("bigint"), **sums}
        held = self.rows.where(F.col("e").isNotNull() & (first < end)).select(
            *groups, first.alias("_first"), F.when(end <= hi, end).alias("_end"), *[v.alias(f"_v_{k}") for k, v in values.items()])
        moves = F.explode(F.array(*[F.struct(F.col(at).alias("e"), *[(F.col(f"_v_{k}") * sign).alias(k) for k in values])
                                    for at, sign in (("_first", 1), ("_end", -1))]))
        changes = (held.select(*groups, moves.alias("_x")).where(F.col("_x.e").isNotNull()).select(*groups, "_x.*")
                   .groupBy(*groups, "e").agg(*[F.sum(k).alias(k) for k in values]))
        order = Window.partitionBy(*groups).orderBy("e")
        running_sums = changes.select(*groups, "e", F.lead("e").over(order).alias("until"), *[F.sum(k).over(order).alias(k) for k in values])
        daily = Periods(running_sums.where("n > 0"), self.dates).per_day(date_col)
        return daily.select(*groups, date_col, *values)


def days_inside(anchor: Column, after: list[int]) -> Column:
    """The epoch days that lie so many days ``after`` (rising) the epoch day ``anchor`` and inside the period; none without an anchor.

    Their places in ``after`` are looked up, so many of them cost no more than few.
    """
    below = after[0] - 1
    counts = [bisect_right(after, d) for d in range(below, after[-1] + 1)]

    def up_to(days: Column) -> Column:  # NULL (an open end, no anchor): all
        return F.get(_int_array(counts), F.greatest(F.lit(0), F.least(days - below, F.lit(len(counts) - 1))))

    first, end = up_to(F.col("e") - anchor), up_to(F.col("until") - 1 - anchor)
    return F.transform(F.slice(_int_array(after), first + 1, end - first), lambda d: d + anchor)


def cut_at(periods: Periods, marks: list[Column], inside: list[Column] = ()) -> Periods:
    """The periods cut where one of their ``marks`` (epoch days, NULL: none) lies inside, and at the days in the arrays ``inside``."""
    found = list(inside)
    if marks:
        found.append(F.filter(F.array(*marks), lambda m: m.isNotNull() & (m > F.col("e")) & (F.col("until").isNull() | (m < F.col("until")))))
    starts = F.array_sort(F.array_distinct(F.concat(F.array(F.col("e")), *found)))
    own = periods.columns
    split = periods.rows.select(*own, "until", starts.alias("_starts")).select(*own, "until", "_starts", F.posexplode("_starts").alias("_i", "e"))
    cut = split.select(*own, "e", F.coalesce(F.get("_starts", F.col("_i") + 1), F.col("until")).alias("until"))
    return Periods(reaching(cut, periods.dates), periods.dates)


def joined(left: Periods, right: Periods) -> Periods:
    """Both sides' columns for the days on which a depot has a period on both; the calendar is the left one's."""
    sides = [(p, [c for c in p.columns if c != "Depotnummer"]) for p in (left, right)]
    rows = [p.rows.select("Depotnummer", "e", F.struct("until", *[F.col(f"`{c}`") for c in own]).alias(f"_p{i}"))
            for i, (p, own) in enumerate(sides)]
    cum, after, closing = running()
    cut = stack(rows).select("Depotnummer", "e", after.alias("_after"), closing.alias("_closing"),
                             *[F.last(f"_p{i}", ignorenulls=True).over(cum).alias(f"_p{i}") for i in (0, 1)]).where("_closing")
    for i in (0, 1):
        cut = cut.where(F.col(f"_p{i}").isNotNull() & (F.col(f"_p{i}.until").isNull() | (F.col(f"_p{i}.until") > F.col("e"))))
    cut = cut.select("Depotnummer", "e", F.least("_p0.until", "_p1.until", "_after").alias("until"),
                     *[F.col(f"_p{i}")[c].alias(c) for i, (_, own) in enumerate(sides) for c in own])
    return Periods(reaching(cut, left.dates), left.dates)


def last_until(periods: DataFrame, dates: DataFrame) -> DataFrame:
    """Only the rows of a timeline that can reach a calendar date: nothing after its last one."""
    hi = epoch_day(dates.select(F.max("as_of")).scalar())
    return periods.where(F.col("e").isNull() | (F.col("e") <= hi))


def reaching(periods: DataFrame, dates: DataFrame) -> DataFrame:
    """Only the periods that have not ended before the calendar's first date."""
    lo = epoch_day(dates.select(F.min("as_of")).scalar())
    return periods.where(F.col("e").isNotNull() & (F.col("until").isNull() | (F.col("until") > lo)))


def running() -> tuple[Window, Column, Column]:
    """The cumulative frame of a depot's stacked rows, the day of its next row, and whether the row is the last of its day."""
    order = Window.partitionBy("Depotnummer").orderBy("e")
    after = F.lead("e").over(order)
    return order.rangeBetween(Window.unboundedPreceding, Window.currentRow), after, after.isNull() | (after != F.col("e"))


def stack(rows: list[DataFrame]) -> DataFrame:
    stacked = rows[0]
    for r in rows[1:]:
        stacked = stacked.unionByName(r, allowMissingColumns=True)
    return stacked


def _active_month_rows(od: DataFrame, begin: Column) -> list[DataFrame]:
    """``c_act``: +1 where a month with orders enters the last six months, -1 where its last order day leaves them."""
    m = month_index(F.col("d"))
    known = od.where(F.col("d").isNotNull())
    if "s" not in od.columns:
        months = (known.groupBy("Depotnummer", m.alias("m")).agg(F.min("d").alias("d0"), F.max("d").alias("d1"))
                  .select("Depotnummer", epoch_day("d0").alias("lo"), _leaves_six_months(F.col("d1")).alias("hi")))
    else:
        # An order day counts from the day it is known; a month counts on the union of these spans.
        spans = known.select("Depotnummer", m.alias("m"), epoch_day("s").alias("lo"), _leaves_six_months(F.col("d")).alias("hi"))
        spans = spans.where(F.col("lo") < F.col("hi")).groupBy("Depotnummer", "m", "lo").agg(F.max("hi").alias("hi"))
        before = Window.partitionBy("Depotnummer", "m").orderBy("lo").rowsBetween(Window.unboundedPreceding, -1)
        months = (spans.select("Depotnummer", F.greatest("lo", F.max("hi").over(before)).alias("lo"), "hi")
                  .where(F.col("lo") < F.col("hi")))
    return _add_and_expire(months, "lo", "hi", "c_act", begin)


def _add_and_expire(df: DataFrame, lo: str, hi: str, c: str, begin: Column) -> list[DataFrame]:
    """What has expired by the day ``begin`` adds up to nothing from there on and is left out."""
    df = df.where(F.col(lo).isNotNull() & (F.col(hi) > begin))
    return [df.select("Depotnummer", F.col(at).alias("e"), F.lit(n).cast("bigint").alias(c)) for at, n in ((lo, 1), (hi, -1))]


def _deposit_volatility_rows(months: DataFrame) -> DataFrame:
    """``ev_dv``: sample deviation of the monthly deposit sums of the last 180 days, for every day on which it changes."""
    entry = F.struct("m", "dep_days", "dep_tot")
    spread = (months.where((F.size("dep_days") > 0) & F.col("m").isNotNull())
              .select("Depotnummer", entry.alias("x"), F.explode(F.sequence(F.col("m"), F.col("m") + 6)).alias("mA")))
    per_month = spread.groupBy("Depotnummer", "mA").agg(F.collect_list("x").alias("months"))
    days = F.flatten(F.transform("months", lambda x: F.flatten(F.transform(x["dep_days"], lambda y: F.array(y["e"], y["e"] + 181)))))
    lo = first_of_month_epoch(F.col("mA"))
    hi = first_of_month_epoch(F.col("mA") + 1)
    changes = (per_month.select("Depotnummer", "mA", "months", lo.alias("lo"), hi.alias("hi"))
               .select("Depotnummer", "mA", "months", F.explode(F.array_distinct(
                   F.filter(days, lambda e: (e >= F.col("lo")) & (e < F.col("hi"))))).alias("e")))
    e_a = F.col("e")
    e_lo = e_a - 180
    m_lo = month_index(as_day(e_lo))

    # Months strictly between the two boundary months count with their total;
    # only the boundary months look at their (at most 31) deposit days.
    def in_window(y):
        return (y["e"] >= e_lo) & (y["e"] <= e_a)

    dep = F.filter("months", lambda x: (x["m"] >= m_lo) & (x["m"] <= F.col("mA")))
    per = F.transform(dep, lambda x: F.when(
        (x["m"] > m_lo) & (x["m"] < F.col("mA")), F.struct(x["dep_tot"].alias("u"), F.lit(True).alias("has")))
        .otherwise(F.struct(
            F.aggregate(F.filter(x["dep_days"], in_window), _unit0(),
                        lambda acc, y: acc + F.coalesce(y["u"], _unit0())).alias("u"),
            F.exists(x["dep_days"], in_window).alias("has"))))
    sums = F.transform(F.filter(per, lambda p: p["has"]), lambda p: p["u"] / 10000.0)
    at = changes.select("Depotnummer", "e", sums.alias("sums"))
    n = F.size("sums")
    mean = F.aggregate("sums", F.lit(0.0), lambda acc, v: acc + v) / n
    var = F.aggregate("sums", F.lit(0.0), lambda acc, v: acc + (v - mean) * (v - mean)) / (n - 1)
    return at.select("Depotnummer", "e", F.struct(F.when(n >= 2, F.sqrt(var)).alias("v")).alias("ev_dv"))


def timeline_periods(tables, dates: DataFrame, fp: P.FeatureParams, same_day_snapshots: bool = False) -> Periods:
    """Base columns (``o_*``, ``b_*``, ``p_*``, ``s_saldo``) of every depot by period.

    A depot has periods from its first order (the day it is known), position
    snapshot or balance on. A snapshot holds until the next one of the depot;
    with ``same_day_snapshots`` it holds on its own date only, and a depot
    without orders exists on such dates only.
    """
    od = OR.order_day_rows(tables.orders)
    e_d = epoch_day("d")
    late = "s" in od.columns
    e_s = epoch_day("s") if late else e_d  # the day an order is known from
    begin = epoch_day(dates.select(F.min("as_of")).scalar())

    def counted(days: int, c: str) -> Column:  # an event that has left the window by the first date adds 0 and needs no expiry row
        return F.when(e_d + days >= begin, F.col(c)).otherwise(F.col(c) * 0)

    def still_in(days: int, c: str) -> Column:
        return F.when(e_s <= e_d + days, counted(days, c)) if late else counted(days, c)

    def expiring(days: int, df: DataFrame | None = None) -> DataFrame:
        if df is None:
            df = od.where(e_s <= e_d + days) if late else od
        return df.where(e_d + days >= begin)

    rows = [
        od.select("Depotnummer", e_s.alias("e"), F.lit(True).alias("ordered"), F.col("ev_o_n").alias("c_n"), F.col("ev_o_vol").alias("c_vol"),
                  still_in(30, "ev_o_n").alias("c_n30"), still_in(30, "ev_o_vol").alias("c_vol30"),
                  still_in(90, "ev_o_n").alias("c_n90"), still_in(90, "ev_o_vol").alias("c_vol90"),
                  e_d.alias("trade_e"), F.when(F.col("ev_o_buy"), e_d).alias("buy_e")),
        expiring(30).select("Depotnummer", (e_d + 31).alias("e"), (-F.col("ev_o_n")).alias("c_n30"),
                            (-F.col("ev_o_vol")).alias("c_vol30")),
        expiring(90).select("Depotnummer", (e_d + 91).alias("e"), (-F.col("ev_o_n")).alias("c_n90"),
                            (-F.col("ev_o_vol")).alias("c_vol90")),
        # +1 on the first order day of each month -> distinct months so far.
        od.groupBy("Depotnummer", month_index(F.col("d")).alias("m"))
          .agg(F.min(e_s).alias("e")).select("Depotnummer", "e", F.lit(1).cast("bigint").alias("c_month")),
        *_active_month_rows(od, begin),
    ]
    if tables.bookings is not None:
        bd = BK.booking_day_rows(tables.bookings, fp)
        rows += [
            bd.select("Depotnummer", e_d.alias("e"), counted(30, "ev_b_in").alias("c_in30"),
                      counted(30, "ev_b_out").alias("c_out30"), counted(90, "ev_b_in").alias("c_in90"),
                      counted(90, "ev_b_out").alias("c_out90"), F.when(F.col("ev_b_nz"), e_d).alias("cf_e"),
                      F.lit(1).cast("bigint").alias("c_book")),
            expiring(30, bd).select("Depotnummer", (e_d + 31).alias("e"), (-F.col("ev_b_in")).alias("c_in30"),
                      (-F.col("ev_b_out")).alias("c_out30")),
            expiring(90, bd).select("Depotnummer", (e_d + 91).alias("e"), (-F.col("ev_b_in")).alias("c_in90"),
                      (-F.col("ev_b_out")).alias("c_out90")),
        ]
        small = F.when(F.col("ev_b_small"), F.col("d"))
        months = (bd.where(F.col("d").isNotNull()).groupBy("Depotnummer", month_index(F.col("d")).alias("m"))
                  .agg(F.min(small).alias("s_first"), F.max(small).alias("s_last"),
                       F.min(F.when(F.col("ev_b_small_in"), e_d)).alias("si_first"),
                       F.collect_list(F.when(F.col("ev_b_has_in"), F.struct(e_d.alias("e"), F.col("ev_b_in").alias("u")))).alias("dep_days"),
                       F.sum(F.when(F.col("ev_b_has_in"), F.coalesce(F.col("ev_b_in"), _unit0()))).alias("dep_tot")))
        rows += _add_and_expire(months.select("Depotnummer", epoch_day("s_first").alias("lo"),
                                              _leaves_six_months(F.col("s_last")).alias("hi")), "lo", "hi", "c_strength", begin)
        rows += _add_and_expire(months.select("Depotnummer", "si_first", first_of_month_epoch(F.col("m") + 4).alias("hi")),
                                "si_first", "hi", "c_plan", begin)
        rows.append(_deposit_volatility_rows(months))
    snaps = POS.position_snapshots(tables.positions, fp.vocab)
    held_rows = [snaps.select("Depotnummer", epoch_day("Datum").alias("e"), POS.snapshot_struct().alias("ev_p"), F.lit(True).alias("snap")),
                 BAL.balance_days(tables.balances).select("Depotnummer", e_d.alias("e"), "ev_s", F.lit(True).alias("snap"))]
    rows += held_rows
    if same_day_snapshots:
        rows += [r.select("Depotnummer", (F.col("e") + 1).alias("e")) for r in held_rows]
    stacked = last_until(stack(rows), dates)
    for c, t in (("c_in30", "bigint"), ("c_out30", "bigint"), ("c_in90", "bigint"), ("c_out90", "bigint"), ("cf_e", "int"),
                 ("c_book", "bigint"), ("c_strength", "bigint"), ("c_plan", "bigint"), ("ev_dv", "struct<v:double>")):
        if c not in stacked.columns:
            stacked = stacked.withColumn(c, F.lit(None).cast(t))

    cum, after, closing = running()

    def s(c):
        return F.sum(c).over(cum)

    def newest(there: Column) -> Column:
        return F.max(F.when(there, F.col("e"))).over(cum)

    def held(c):
        last = F.last(c, ignorenulls=True).over(cum)
        return F.when(newest(F.col(c).isNotNull()) == F.col("e"), last) if same_day_snapshots else last

    snapped = newest(F.col("snap"))
    present = newest(F.col("ordered")).isNotNull() | F.coalesce(snapped == F.col("e") if same_day_snapshots else snapped.isNotNull(), F.lit(False))
    measured = stacked.select(
        "Depotnummer", "e", after.alias("until"), closing.alias("closing"), present.alias("present"),
        s("c_n").alias("o_n"), s("c_vol").alias("o_vol"),
        s("c_n30").alias("o_n30"), s("c_vol30").alias("o_vol30"),
        s("c_n90").alias("o_n90"), s("c_vol90").alias("o_vol90"),
        s("c_month").alias("o_months"), s("c_act").alias("act6"),
        F.max("trade_e").over(cum).alias("trade_e"), F.max("buy_e").over(cum).alias("buy_e"),
        s("c_in30").alias("b_in30"), s("c_out30").alias("b_out30"),
        s("c_in90").alias("b_in90"), s("c_out90").alias("b_out90"),
        s("c_strength").alias("strength"), s("c_plan").alias("plan"),
        s("c_book").alias("n_book"), F.max("cf_e").over(cum).alias("cf_e"),
        held("ev_p").alias("p"), held("ev_s").alias("s_saldo"),
        F.last("ev_dv", ignorenulls=True).over(cum).alias("dv"),
    ).where(F.col("closing") & F.col("present"))
    has_orders = F.col("o_n").isNotNull()
    has_book = F.col("n_book").isNotNull()

    def months_of(there: Column, c: str) -> Column:
        return F.when(there, F.coalesce(F.col(c), _unit0()).cast("int"))

    return Periods(reaching(measured, dates).select(
        "Depotnummer", "e", "until",
        as_day(F.col("buy_e")).alias("o_last_buy"), as_day(F.col("trade_e")).alias("o_last_trade"),
        "o_n", "o_vol", "o_n30", "o_vol30", "o_n90", "o_vol90", "o_months",
        months_of(has_orders, "act6").alias("o_act6"),
        "b_in30", "b_out30", "b_in90", "b_out90",
        months_of(has_book, "plan").alias("b_plan_months"), months_of(has_book, "strength").alias("b_strength"),
        F.when(has_book, F.col("dv")["v"]).alias("b_dep_vol"),
        as_day(F.col("cf_e")).alias("b_last_cf"),
        *[F.col("p")[c].alias(c) for c in POS.SNAPSHOT_FIELDS],
        "s_saldo"), dates)
