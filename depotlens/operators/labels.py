"""Event labels for the models.

* Investment labels: 1 if the depot has an investment event (an order, or a
  day whose deposits sum to at least ``min_deposit``) in [d+1, d+H].
* First-buy labels: 1 if the depot's first effective buy of the target
  security (order type "Ankauf", ticket >= 1,000, transaction not cancelled)
  falls in (d, d+T].

"Any event in a future window" is read from the depot's own timeline: label
rows and event rows are stacked, partitioned by depot and ordered by day
(descending); a running sum with add-and-expire rows answers every label row
in one pass, with no date x event join and no sliding frame. Every depot
contributes at most one event row per day, so a very active depot stays a
small partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from depotlens import params as P
from depotlens.functions.columns import epoch_day, money_units
from depotlens.operators.timeline import Periods, last_until, reaching, running, stack


# --------------------------------------------------------------------------
# Investment events and labels
# --------------------------------------------------------------------------

def investment_events(orders: DataFrame, bookings: DataFrame | None, min_deposit: float = 100.0,
                      order_status_col: str | None = None, booking_type_col: str | None = None,
                      lo=None, hi=None) -> DataFrame:
    """Distinct (Depotnummer, event_date): order days, plus days whose credited
    deposits sum to at least ``min_deposit``.

    Orders can be restricted to executed statuses; deposits are bookings of a
    credit type when a type column is named, else bookings with a positive
    amount. ``lo``/``hi`` restrict the event dates (pushed to the scans).
    """
    o = orders
    if order_status_col and order_status_col in o.columns:
        o = o.where(F.upper(F.col(order_status_col)).isin([v.upper() for v in P.ORDER_EXEC_VALUES]))
    od = o.select("Depotnummer", F.col("Orderdatum").alias("event_date"))
    if lo is not None:
        od = od.where(F.col("event_date") >= lo)
    if hi is not None:
        od = od.where(F.col("event_date") <= hi)
    ev = od
    if bookings is not None:
        b = bookings
        if booking_type_col and booking_type_col in b.columns:
            b = b.where(F.col(booking_type_col).isin(*P.BOOKING_CREDIT_VALUES))
        else:
            b = b.where(F.col("Betrag") > 0)
        b = b.select(F.col("Kontoreferenz").alias("Depotnummer"), F.col("Buchungdatum").alias("event_date"),
                     money_units("Betrag").alias("u"))
        if lo is not None:
            b = b.where(F.col("event_date") >= lo)
        if hi is not None:
            b = b.where(F.col("event_date") <= hi)
        deposits = (b.groupBy("Depotnummer", "event_date").agg(F.sum("u").alias("u"))
                    .where(F.col("u") >= F.lit(int(round(min_deposit * 10000))))
                    .select("Depotnummer", "event_date"))
        ev = ev.unionByName(deposits)
    return ev.where(F.col("Depotnummer").isNotNull() & F.col("event_date").isNotNull()).distinct()


def label_future_events(rows: DataFrame, events: DataFrame, horizons, date_col: str = "stichtag",
                        prefix: str = "label_invest_T") -> DataFrame:
    """Add ``<prefix><H>`` (INT 0/1) per horizon: an event in [d+1, d+H].

    Walking each depot's timeline backwards (descending day), an event on day
    e adds 1 from day e-1 on and an expiry row removes it again from day
    e-H-1 on, so the running sum at a label row d counts exactly the events in
    [d+1, d+H]. The frame is cumulative (incremental), whatever H is.
    """
    # The caller's rows travel through the timeline with all their columns, so
    # no join back (and no de-duplication) is needed.
    r = rows.select("*", epoch_day(date_col).alias("_c"), F.lit(True).alias("_label"))
    e = events.select("Depotnummer", epoch_day("event_date").alias("_e")).distinct()
    parts = [r, e.select("Depotnummer", (F.col("_e") - 1).alias("_c"),
                         *[F.lit(1).alias(f"_n{h}") for h in horizons])]
    for h in horizons:
        parts.append(e.select("Depotnummer", (F.col("_e") - int(h) - 1).alias("_c"), F.lit(-1).alias(f"_n{h}")))
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p, allowMissingColumns=True)
    w = (Window.partitionBy("Depotnummer").orderBy(F.desc("_c"))
         .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    cols = [(F.coalesce(F.sum(f"_n{h}").over(w), F.lit(0)) > 0).cast("int").alias(f"{prefix}{h}") for h in horizons]
    return (stacked.select(*rows.columns, "_label", *cols).where(F.col("_label"))
            .drop("_label"))


def label_periods(periods: Periods, events: DataFrame, horizons, prefix: str = "label_invest_T") -> Periods:
    """``label_future_events`` of every date in the periods: they are cut where
    a label changes. An event on day e labels the days from e-H to e-1."""
    own = [c for c in periods.columns if c != "Depotnummer"]
    e = events.select("Depotnummer", epoch_day("event_date").alias("_e")).distinct()
    rows = [reaching(periods.rows, periods.dates).select("Depotnummer", "e", F.struct("until", *own).alias("_row")),
            e.select("Depotnummer", F.col("_e").alias("e"), *[F.lit(-1).alias(f"_n{h}") for h in horizons])]
    rows += [e.select("Depotnummer", (F.col("_e") - int(h)).alias("e"), F.lit(1).alias(f"_n{h}")) for h in horizons]
    cum, after, closing = running()
    cut = last_until(stack(rows), periods.dates).select(
        "Depotnummer", "e", after.alias("_after"), closing.alias("_closing"), F.last("_row", ignorenulls=True).over(cum).alias("_row"),
        *[(F.coalesce(F.sum(f"_n{h}").over(cum), F.lit(0)) > 0).cast("int").alias(f"{prefix}{h}") for h in horizons])
    held = F.col("_row").isNotNull() & (F.col("_row.until").isNull() | (F.col("_row.until") > F.col("e")))
    cut = cut.where(F.col("_closing") & held).select(
        "Depotnummer", "e", F.least("_row.until", "_after").alias("until"), *[F.col(f"_row.`{c}`").alias(c) for c in own],
        *[f"{prefix}{h}" for h in horizons])
    return Periods(reaching(cut, periods.dates), periods.dates)


def invest_labels(rows: DataFrame | Periods, orders: DataFrame, bookings: DataFrame | None, horizons=(7, 14),
                  min_deposit: float = 100.0, date_col: str = "stichtag", dates: DataFrame | None = None) -> DataFrame | Periods:
    """Investment labels for the (Depotnummer, ``date_col``) rows, or for periods, which stay periods.

    Events are read only for [min(d)+1, max(d)+max(H)] (scalar subqueries,
    so the bounds reach the scans as literals). ``dates`` (column ``as_of``) is
    the calendar the rows were made for: with it the bounds come from the
    calendar and the rows are not computed a second time for them.
    """
    if isinstance(rows, Periods):
        dates = rows.dates
    calendar, c = (rows, date_col) if dates is None else (dates, "as_of")
    lo = F.date_add(calendar.select(F.min(c)).scalar(), 1)
    hi = F.date_add(calendar.select(F.max(c)).scalar(), int(max(horizons)))
    ev = investment_events(orders, bookings, min_deposit, lo=lo, hi=hi)
    if isinstance(rows, Periods):
        return label_periods(rows, ev, horizons)
    return label_future_events(rows, ev, horizons, date_col)


def upsert_labels(existing: DataFrame, new: DataFrame, keys=("Depotnummer", "stichtag"), created_at=None) -> DataFrame:
    """MERGE of label columns: new values win, label columns of other horizons
    are kept, new keys are inserted. Result columns: keys + union of label
    columns (+ created_at: the given run time on every new row)."""
    if created_at is not None:
        new = new.withColumn("created_at", F.lit(created_at).cast("timestamp"))
    keys = list(keys)
    e_cols = [c for c in existing.columns if c not in keys]
    n_cols = [c for c in new.columns if c not in keys]
    out = [F.coalesce(F.col(f"e.{k}"), F.col(f"n.{k}")).alias(k) for k in keys]
    for c in dict.fromkeys(e_cols + n_cols):
        if c in n_cols and c in e_cols:
            out.append(F.when(F.col("_in_new"), F.col(f"n.{c}")).otherwise(F.col(f"e.{c}")).alias(c))
        elif c in n_cols:
            out.append(F.col(f"n.{c}").alias(c))
        else:
            out.append(F.col(f"e.{c}").alias(c))
    n = new.withColumn("_in_new", F.lit(True))
    cond = [F.col(f"e.{k}") == F.col(f"n.{k}") for k in keys]
    j = existing.alias("e").join(n.alias("n"), cond, "full_outer")
    return j.select(*out)


# --------------------------------------------------------------------------
# First buy of a target security
# --------------------------------------------------------------------------

def _cancelled_tx(orders: DataFrame, lo=None, hi=None) -> DataFrame:
    s = orders.where(F.col("Bemerkung").ilike("%storn%") & F.col("Transaktionsnummer").isNotNull())
    if lo is not None:
        s = s.where(F.col("Orderdatum") >= lo)
    if hi is not None:
        s = s.where(F.col("Orderdatum") <= hi)
    return s.select(F.col("Transaktionsnummer").alias("tx")).distinct()


def effective_target_buys(orders: DataFrame, fb: P.FirstBuyParams, lo=None, hi=None,
                          storno_lo=None, storno_hi=None) -> DataFrame:
    """Target-security buys with ticket >= min_ticket whose transaction was not
    cancelled (orders without a transaction number always count)."""
    b = orders.where((F.col("ISIN") == fb.isin) & (F.col("Ordertyp") == P.ORDER_TYPE_BUY)
                     & (F.abs(F.coalesce(F.col("Cashflow"), F.lit(0.0))) >= fb.min_ticket))
    if lo is not None:
        b = b.where(F.col("Orderdatum") > lo)
    if hi is not None:
        b = b.where(F.col("Orderdatum") <= hi)
    b = b.select("Depotnummer", "Orderdatum", F.col("Transaktionsnummer").alias("tx"))
    return _not_cancelled(b, _cancelled_tx(orders, storno_lo, storno_hi))


def _not_cancelled(b: DataFrame, cancelled: DataFrame) -> DataFrame:
    """Rows whose transaction is not cancelled. Rows without a transaction
    number always survive; they bypass the shuffle join, so a large share of
    missing numbers cannot pile up in the one task that owns the NULL key."""
    return (b.where(F.col("tx").isNull())
            .unionByName(b.where(F.col("tx").isNotNull()).join(cancelled, "tx", "left_anti")))


def first_target_buy(orders: DataFrame, start, end, fb: P.FirstBuyParams = P.FirstBuyParams()) -> DataFrame:
    """First effective target buy per depot in (start, end + 30 days];
    cancellations are searched within the window widened by the margin."""
    s = F.lit(str(start)).cast("date")
    e30 = F.date_add(F.lit(str(end)).cast("date"), 30)
    m = fb.storno_margin_days
    buys = effective_target_buys(orders, fb, lo=s, hi=e30, storno_lo=F.date_sub(s, m), storno_hi=F.date_add(e30, m))
    return buys.groupBy("Depotnummer").agg(F.min("Orderdatum").alias("first_buy_date"))


def first_buy_labels(rows: DataFrame, first_buy: DataFrame, horizons=(7, 14, 30),
                     date_col: str = "Stichtag") -> DataFrame:
    """label_T{H} = first buy in (d, d+H] for each (Depotnummer, d) row."""
    df = rows.select("Depotnummer", date_col).join(first_buy, "Depotnummer", "left")
    fbd = F.col("first_buy_date")
    labels = [((fbd.isNotNull()) & (fbd > F.col(date_col)) & (fbd <= F.date_add(F.col(date_col), int(h))))
              .cast("int").alias(f"label_T{h}") for h in horizons]
    return df.select("Depotnummer", date_col, "first_buy_date", *labels)


def pre_first_target(rows: DataFrame, orders: DataFrame, fb: P.FirstBuyParams = P.FirstBuyParams(),
                     date_col: str = "Score_Datum") -> DataFrame:
    """Pre_First_Target = 1 while the depot has no effective target buy on or
    before the date; First_Target_Buy = date of its first one (whole history)."""
    first = (effective_target_buys(orders, fb).groupBy("Depotnummer")
             .agg(F.min("Orderdatum").alias("First_Target_Buy")))
    df = rows.join(first, "Depotnummer", "left")
    pre = (F.col("First_Target_Buy").isNull() | (F.col("First_Target_Buy") > F.col(date_col))).cast("int")
    return df.withColumn("Pre_First_Target", pre)


# --------------------------------------------------------------------------
# First-buy feature table
# --------------------------------------------------------------------------

def _flagged_orders(orders: DataFrame, fb: P.FirstBuyParams) -> DataFrame:
    """All orders with ``buy`` (effective: right type, ticket >= min_ticket, not
    cancelled), ``target`` (an effective buy of the target security) and
    ``storno`` (carries a cancellation remark). Orders without a transaction
    number bypass the join that finds cancelled ones."""
    ticket = F.abs(F.coalesce(F.col("Cashflow"), F.lit(0.0)))
    o = orders.select(
        "Depotnummer", "Orderdatum", "ISIN", "Cashflow", F.col("Transaktionsnummer").alias("tx"),
        ((F.col("Ordertyp") == P.ORDER_TYPE_BUY) & (ticket >= fb.min_ticket)).alias("buy"),
        F.coalesce(F.col("Bemerkung").ilike("%storn%"), F.lit(False)).alias("storno"))
    gone = o.where(F.col("storno") & F.col("tx").isNotNull()).select("tx").distinct().withColumn("gone", F.lit(True))
    free = o.where(F.col("tx").isNull()).withColumn("gone", F.lit(None).cast("boolean"))
    o = o.where(F.col("tx").isNotNull()).join(gone, "tx", "left").unionByName(free)
    buy = F.coalesce(F.col("buy"), F.lit(False)) & F.col("gone").isNull()
    return o.select("Depotnummer", "Orderdatum", "ISIN", "Cashflow", "storno", buy.alias("buy"),
                    (buy & F.coalesce(F.col("ISIN") == fb.isin, F.lit(False))).alias("target"))


def first_buy_features(features: DataFrame | Periods, orders: DataFrame, as_of=None,
                       fb: P.FirstBuyParams = P.FirstBuyParams(), never_days: int = 0, held=None) -> DataFrame:
    """Feature table of the first-buy model for every (depot, date) row of
    ``features``, or only those of the date ``as_of``. Feature periods are cut
    where an order comes in or leaves a window, and laid over their calendar
    last; ``held`` changes (e.g. rounds) their columns before that, once per period.

    Taken from the depot features: Cash (= Cash_abs), Cash_Ratio
    (= Cashquote_true), Deposit_30d_eff, Pos_Count. Defined here:

    * Buys_7d / Buys_30d – effective buys (any security, ticket >= 1,000, not
      cancelled) in the last 7 / 30 days (inclusive bounds, as all windows);
    * Last_Buy_Days – days since the last effective buy (``never_days`` if none);
    * Avg_Ticket_90d – mean ticket of effective buys in 90 days (0 if none);
    * Turnover – sum of |cash flow| of all orders in 90 days / Depotwert
      (0 when Depotwert <= 0);
    * NewRefs_90d – securities whose first effective buy by the depot lies in
      the last 90 days;
    * CancelRate_30d – orders with a cancellation remark / all orders in 30 days
      (0 without orders);
    * Pre_First_Target, First_Target_Buy – see ``pre_first_target``.

    Orders are flagged once and summed per depot and day. On the depot's
    timeline a day's sums are added on that day and taken back when its
    window has passed, so every frame is cumulative and the number of dates
    does not multiply the history.
    """
    from depotlens.functions.columns import money_units
    by_period = isinstance(features, Periods)
    if as_of is not None:
        features = features.between(as_of, as_of) if by_period else features.where(F.col("Score_Datum") == F.lit(str(as_of)).cast("date"))
    flagged = _flagged_orders(orders, fb)
    amount = money_units(F.abs(F.coalesce(F.col("Cashflow"), F.lit(0.0))))
    per_ref = flagged.groupBy("Depotnummer", "Orderdatum", "ISIN").agg(
        F.count_if("buy").alias("buys"), F.sum(F.when(F.col("buy"), amount)).alias("tickets"),
        F.sum(amount).alias("volume"), F.count(F.lit(1)).alias("orders"), F.count_if("storno").alias("stornos"),
        F.count_if("target").alias("targets"))
    # The first buying day of each security: a depot's securities, not its orders, are compared.
    firsts = (per_ref.where("buys > 0").groupBy("Depotnummer", "ISIN").agg(F.min("Orderdatum").alias("Orderdatum"))
              .groupBy("Depotnummer", "Orderdatum").agg(F.count(F.lit(1)).alias("refs")))
    per_day = per_ref.groupBy("Depotnummer", "Orderdatum").agg(*[
        F.sum(c).alias(c) for c in ("buys", "tickets", "volume", "orders", "stornos", "targets")])
    per_day = per_day.join(firsts, ["Depotnummer", "Orderdatum"], "left")
    sums = {"b7": ("buys", 7), "b30": ("buys", 30), "t90": ("tickets", 90), "n90": ("buys", 90), "v90": ("volume", 90),
            "o30": ("orders", 30), "c30": ("stornos", 30), "r90": ("refs", 90)}

    def step(window, sign):
        return F.struct((F.col("d") + (0 if sign > 0 else window + 1)).alias("c"), *[
            F.when(F.lit(w == window), F.coalesce(F.col(c), F.lit(0)) * sign).otherwise(F.lit(0)).cast("bigint").alias(k)
            for k, (c, w) in sums.items()],
            *[F.when(F.lit(sign > 0 and window == 7) & (F.col(c) > 0), F.col("d")).alias(k)
              for k, c in (("buy_day", "buys"), ("target_day", "targets"))])

    moves = (per_day.withColumn("d", epoch_day("Orderdatum"))
             .select("Depotnummer", F.explode(F.array(*[step(w, s) for w in (7, 30, 90) for s in (1, -1)])).alias("x"))
             .select("Depotnummer", "x.*"))
    taken = ("Cash_abs", "Cashquote_true", "Einzahlung_30d_eff", "Pos_Count", "Depotwert")
    z = F.lit(0.0)
    days = F.coalesce(F.col("c") - F.col("last_buy"), F.lit(never_days)).cast("bigint").alias("Last_Buy_Days")
    columns = [
        F.col("b7").alias("Buys_7d"), F.col("b30").alias("Buys_30d"),
        F.when(F.col("n90") > 0, F.col("t90").cast("double") / F.col("n90") / 10000.0).otherwise(z).alias("Avg_Ticket_90d"),
        F.col("Cash_abs").alias("Cash"), F.col("Cashquote_true").alias("Cash_Ratio"),
        F.col("Einzahlung_30d_eff").alias("Deposit_30d_eff"),
        F.when(F.col("Depotwert") > 0, F.col("v90").cast("double") / 10000.0 / F.col("Depotwert")).otherwise(z).alias("Turnover"),
        F.col("Pos_Count"), F.col("r90").alias("NewRefs_90d"),
        F.when(F.col("o30") > 0, F.col("c30") / F.col("o30")).otherwise(z).alias("CancelRate_30d"),
        (F.col("first_target").isNull() | (F.col("first_target") > F.col("c"))).cast("int").alias("Pre_First_Target"),
        F.date_add(F.lit("1970-01-01").cast("date"), F.col("first_target")).alias("First_Target_Buy")]
    depot = Window.partitionBy("Depotnummer")
    until = depot.orderBy("c").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    known = [*[F.coalesce(F.sum(k).over(until), F.lit(0)).alias(k) for k in sums],
             F.max("buy_day").over(until).alias("last_buy"), F.min("target_day").over(depot).alias("first_target")]
    if by_period:
        rows = reaching(features.rows, features.dates).select("Depotnummer", F.col("e").alias("c"), F.struct("until", *taken).alias("_row"))
        after = F.lead("c").over(depot.orderBy("c"))
        j = stack([rows, moves]).select("Depotnummer", "c", after.alias("_after"), F.last("_row", ignorenulls=True).over(until).alias("_row"), *known)
        j = j.where((F.col("_after").isNull() | (F.col("_after") != F.col("c"))) & F.col("_row").isNotNull())
        j = j.where(F.col("_row.until").isNull() | (F.col("_row.until") > F.col("c")))
        j = j.select("Depotnummer", "c", F.col("c").alias("e"), F.least("_row.until", "_after").alias("until"), "last_buy", "first_target", *sums,
                     *[F.col(f"_row.{c}").alias(c) for c in taken]).select("Depotnummer", "e", "until", "last_buy", *columns)
        p = Periods(reaching(j if held is None else held(j), features.dates), features.dates)
        daily = p.per_day().withColumn("c", epoch_day("Score_Datum"))
        names = [c for c in p.columns if c not in ("Depotnummer", "last_buy")]
        return daily.select("Depotnummer", "Score_Datum", *names[:2], days, *names[2:])
    rows = features.select("Depotnummer", "Score_Datum", *taken, epoch_day("Score_Datum").alias("c"))
    line = rows.withColumn("_row", F.lit(True)).unionByName(moves, allowMissingColumns=True)
    j = line.select("Depotnummer", "Score_Datum", *taken, "c", "_row", *known).where("_row")
    return j.select("Depotnummer", "Score_Datum", *columns[:2], days, *columns[2:])
