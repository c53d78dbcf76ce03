"""Sources, universe and text jobs."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions import text as X
from barloom.functions.frames import full_mean, ordered, ratio
from barloom.operators import universe as U
from barloom.plans import inputs as I
from barloom.plans.registry import query, view
from barloom.sources import bars as B
from barloom.sources import checks as C
from barloom.sources import flows as FL
from barloom.sources import statements as S


@query("daily_bars", "select * from v_bars")
def daily_bars(spark, d):
    return I.bars(spark, d)


@query(
    "latest_vs_sma20",
    """
    select ticker, sector, date, close, round(sma20, 6) sma20, round((close / sma20 - 1) * 100, 6) dist_pct
    from (select *, case when count(close) over w = 20 then avg(close) over w end sma20,
            row_number() over (partition by ticker order by date desc) rn
          from v_bars window w as (partition by ticker order by date rows between 19 preceding and current row))
    where rn = 1
    """,
)
def latest_vs_sma20(spark, d):
    w = ordered("ticker")
    rows = I.bars(spark, d).withColumn("sma20", full_mean("close", w, 20))
    last = rows.groupBy("ticker", "sector").agg(
        *[F.max_by(c, "date").alias(c) for c in ("date", "close", "sma20")]
    )
    return last.select(
        "ticker", "sector", "date", "close", F.round("sma20", 6).alias("sma20"),
        F.round((F.col("close") / F.col("sma20") - 1) * 100, 6).alias("dist_pct"),
    )


@query(
    "supplier_bars",
    """
    select l_suppkey, date, first(price order by ok, ln, price) open, max(price) high, min(price) low,
      first(price order by ok desc, ln desc, price desc) close, cast(sum(size) as bigint) volume
    from v_trades group by 1, 2
    """,
)
def supplier_bars(spark, d):
    """Bars at the finest instrument grain, for wide universes."""
    return B.build_bars(
        I.trades(spark, d), ["l_suppkey"], F.col("date"), "date", ["seq"]
    ).drop("value")


@query("index_bars", "select * from v_index")
def index_bars(spark, d):
    return I.index(spark, d)


@query("peer_index_bars", "select * from v_peer")
def peer_index_bars(spark, d):
    return I.peer_index(spark, d)


@query("intraday_bars", "select * from v_5m")
def intraday_bars(spark, d):
    return I.bars_5m(spark, d)


@query(
    "latest_tick_snapshot",
    """
    with dayed as (select *, max(cast(ts as date)) over (partition by ticker) last_day from v_ticks)
    select ticker, max(ts) last_at, arg_max(price, (ts, event_id)) last_price, cast(sum(size) as bigint) day_volume,
      cast(sum(price * size) as bigint) day_value
    from dayed where cast(ts as date) = last_day group by ticker
    """,
)
def latest_tick_snapshot(spark, d):
    return B.latest_snapshot(I.ticks(spark, d), "ticker", "ts", "price", "size", ["seq"])


@query(
    "bar_upsert_keep_last",
    """
    with stacked as (
      select ticker, date, first(price order by ok, ln, price) open,
        first(price order by ok desc, ln desc, price desc) close, cast(sum(size) as bigint) volume, 1 batch
      from v_trades where flag <> 'R' group by 1, 2
      union all
      select ticker, date, open, close, volume, 2 from v_bars where date >= date '1998-01-01')
    select ticker, date, open, close, volume from stacked
    qualify row_number() over (partition by ticker, date order by batch desc) = 1
    """,
)
def bar_upsert_keep_last(spark, d):
    """An early batch without returned lines, overwritten by the corrected batch of later years."""
    fields = ["ticker", "date", "open", "close", "volume"]
    trades = I.trades(spark, d)
    early = B.build_bars(trades.filter("flag <> 'R'"), ["ticker"], F.col("date"), "date", ["seq"])
    late = I.bars(spark, d).filter("date >= date '1998-01-01'")
    stacked = early.select(*fields, F.lit(1).alias("batch")).unionByName(
        late.select(*fields, F.lit(2).alias("batch"))
    )
    return B.upsert_keep_last(stacked, ["ticker", "date"], "batch")


@query(
    "refresh_plan",
    """
    select ticker, count(*) bars,
      case when min(date) > date '2001-11-05' - 2500 then date '2001-11-05' - 2500 end backfill_from,
      case when min(date) > date '2001-11-05' - 2500 then min(date) - 1 end backfill_to,
      max(date) - 3 tail_from, date '2001-11-05' tail_to
    from v_bars group by ticker
    """,
)
def refresh_plan(spark, d):
    return B.refresh_plan(I.bars(spark, d), "2001-11-05", 2500, 3)


@query("history_summary", "select ticker, count(*) bars, min(date) first_date, max(date) last_date from v_bars group by 1")
def history_summary(spark, d):
    return B.history_summary(I.bars(spark, d))


@query(
    "partial_bar_exclusion",
    """
    select ticker, date, close from (select *, count(*) over (partition by ticker) n, max(date) over () m from v_bars)
    where not (date = date '2001-11-03' and n >= 2)
    """,
)
def partial_bar_exclusion(spark, d):
    return B.drop_partial_bar(I.bars(spark, d), "2001-11-03 10:30:00").select("ticker", "date", "close")


@query(
    "reference_override",
    """
    with ref as (
      select ticker, try_cast(case when min(s_acctbal) < 0 then 'n/a' else cast(cast(round(min(s_acctbal)) as bigint) as varchar) end as double) ref
      from supplier join v_inst on s_nationkey = n_nationkey group by 1),
    last as (select ticker, arg_max(close, date) last_close from v_bars group by 1)
    select ticker, last_close, coalesce(ref, last_close) reference, ref is not null overridden
    from last left join ref using (ticker)
    """,
)
def reference_override(spark, d):
    worst = F.min("s_acctbal")
    overrides = (
        I.table(spark, d, "supplier")
        .join(I.instruments(spark, d), F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy("ticker")
        .agg(F.when(worst < 0, "n/a").otherwise(F.round(worst).cast("long").cast("string")).alias("ref"))
    )
    return U.override_reference(I.bars(spark, d), overrides)


@query("factor_series", "select * from v_factors")
def factor_series(spark, d):
    return I.factors(spark, d)


@query(
    "factor_text_parse",
    """
    select c_mktsegment factor, cast(o_orderdate as date) date,
      round(arg_max(o_totalprice, o_orderkey), 2) "value"
    from orders join customer on o_custkey = c_custkey
    where o_orderpriority <> '5-LOW' group by 1, 2
    """,
)
def factor_text_parse(spark, d):
    """Series given as text in two date formats with unusable values: coerce, drop, keep last per date."""
    as_text = (
        I.table(spark, d, "orders")
        .join(I.table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("c_mktsegment").alias("factor"),
            F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
            .otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
            .alias("day"),
            F.when(F.col("o_orderpriority") == "5-LOW", ".").otherwise(F.col("o_totalprice").cast("string")).alias("text"),
            "o_orderkey",
        )
    )
    parsed = as_text.select(
        "factor",
        F.coalesce(F.try_to_date("day", "yyyy-MM-dd"), F.try_to_date("day", "yyyyMMdd")).alias("date"),
        X.safe_double(F.col("text")).alias("value"),
        "o_orderkey",
    ).filter("date is not null and value is not null")
    return B.upsert_keep_last(parsed, ["factor", "date"], "o_orderkey").withColumn("value", F.round("value", 2))


@query(
    "factor_matrix",
    """
    select date, max(case when factor = 'AUTOMOBILE' then "value" end) "AUTOMOBILE",
      max(case when factor = 'BUILDING' then "value" end) "BUILDING",
      max(case when factor = 'FURNITURE' then "value" end) "FURNITURE",
      max(case when factor = 'HOUSEHOLD' then "value" end) "HOUSEHOLD",
      max(case when factor = 'MACHINERY' then "value" end) "MACHINERY"
    from v_factors group by date
    """,
)
def factor_matrix(spark, d):
    names = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    return I.factors(spark, d).groupBy("date").pivot("factor", names).agg(F.max("value"))


@query(
    "flow_entry_mapping",
    """
    select ticker, date,
      cast(sum(case when flag <> 'R' then size else 0 end) as bigint) buy_shares,
      cast(sum(case when flag = 'R' then size else 0 end) as bigint) sell_shares,
      sum(case when flag <> 'R' then size * price else 0 end) / 1e9 buy_billion,
      sum(case when flag = 'R' then size * price else 0 end) / 1e9 sell_billion,
      cast(sum(case when flag <> 'R' then size else -size end) as bigint) net_shares,
      sum(case when flag <> 'R' then size * price else -size * price end) / 1e9 net_billion
    from v_trades group by 1, 2
    """,
)
def flow_entry_mapping(spark, d):
    """JSON flow entries per instrument and month, mapped back to daily flow rows."""
    buy, sell = F.col("flag") != "R", F.col("flag") == "R"
    worth = F.col("size") * F.col("price")
    daily = I.trades(spark, d).groupBy("ticker", "date").agg(
        F.sum(F.when(buy, F.col("size"))).alias("buy_shares"),
        F.sum(F.when(sell, F.col("size"))).alias("sell_shares"),
        F.sum(F.when(buy, worth)).cast("double").alias("buy_value"),
        F.sum(F.when(sell, worth)).cast("double").alias("sell_value"),
    )
    entry = F.struct(
        F.date_format("date", "dd/MM/yyyy").alias("day"), "buy_shares", "sell_shares", "buy_value", "sell_value"
    )
    payloads = daily.groupBy("ticker", F.trunc("date", "month").alias("month")).agg(
        F.to_json(F.collect_list(entry)).alias("payload")
    )
    return FL.map_flow_entries(payloads, "payload", ["ticker"])


view(
    "v_statement",
    """
    select ticker, period_end, period_end + (case when quarter(period_end) = 4 then 75 else 45 end) available_date,
      revenue, units from v_quarters
    """,
)


def statement_tables(spark, d):
    """Nested statement tables: labels, ranges and rows of text cells per instrument."""
    q = I.quarters(spark, d)
    cell = F.struct(
        "period_end",
        F.concat(F.lit("Q"), F.quarter("period_end"), F.lit("/"), F.year("period_end")).alias("label"),
        F.concat(F.lit("01/01/2000 - "), F.date_format("period_end", "dd/MM/yyyy")).alias("span"),
        F.format_number("revenue", 0).alias("revenue"),
        F.concat(F.lit(" "), F.col("units").cast("string"), F.lit(" %")).alias("units"),
    )
    packed = q.groupBy("ticker").agg(F.array_sort(F.collect_list(cell)).alias("c"))

    def line(label, field):
        return F.struct(F.lit(label).alias("label"), F.transform("c", lambda e: e[field]).alias("values"))

    return packed.select(
        "ticker",
        F.transform("c", lambda e: e["label"]).alias("period_labels"),
        F.transform("c", lambda e: F.when(F.quarter(e["period_end"]) == 1, e["span"])).alias("date_ranges"),
        F.array(line("Doanh thu thuần", "revenue"), line("  Số lượng (đơn vị)", "units"), line("Khác", "units")).alias("rows"),
    )


def statement_aliases(spark):
    return spark.createDataFrame(
        [("doanh thu thuan", "revenue", 1), ("so luong don vi", "units", 1)], "label string, field string, priority int"
    )


@query(
    "statement_facts",
    """
    select ticker, 'revenue' field, period_end, cast(revenue as double) "value", available_date from v_statement
    union all select ticker, 'units', period_end, cast(units as double), available_date from v_statement
    """,
)
def statement_facts(spark, d):
    return S.statement_facts(statement_tables(spark, d), statement_aliases(spark))


@query(
    "statement_features",
    """
    select ticker, period_end, available_date, cast(revenue as double) revenue, cast(units as double) units,
      round((revenue / nullif(lag(revenue, 1) over w, 0) - 1) * 100, 6) revenue_qoq_pct,
      round((revenue / nullif(lag(revenue, 4) over w, 0) - 1) * 100, 6) revenue_yoy_pct,
      round((units / nullif(lag(units, 1) over w, 0) - 1) * 100, 6) units_qoq_pct,
      round((units / nullif(lag(units, 4) over w, 0) - 1) * 100, 6) units_yoy_pct,
      round(units / nullif(revenue, 0) * 1e6, 6) units_to_revenue
    from v_statement window w as (partition by ticker order by period_end)
    """,
)
def statement_features(spark, d):
    facts = S.statement_facts(statement_tables(spark, d), statement_aliases(spark))
    out = S.statement_features(facts, ["revenue", "units"])
    out = out.withColumn("units_to_revenue", F.col("units_to_revenue") * 1e6)
    keep = {"ticker", "period_end", "available_date", "revenue", "units"}
    return out.withColumns({c: F.round(c, 6) for c in out.columns if c not in keep})


@query(
    "factor_freshness",
    """
    with expected as (select c_mktsegment factor from customer group by 1 union select 'GOLD'),
    stats as (select factor, count(*) row_count, max(date) latest_date, arg_max("value", date) latest_value from v_factors group by 1)
    select factor, coalesce(row_count, 0) row_count, latest_date, latest_value,
      case when row_count is null then 'no rows' end error
    from expected left join stats using (factor)
    """,
)
def factor_freshness(spark, d):
    extra = spark.createDataFrame([("GOLD",)], "factor string")
    expected = I.table(spark, d, "customer").select(F.col("c_mktsegment").alias("factor")).union(extra)
    return C.freshness(expected, I.factors(spark, d), "factor", "date", "value")


@query(
    "coverage_gaps",
    """
    select ticker, y "year" from (select ticker from v_inst), (select unnest(range(min(year(date)), max(year(date)) + 1)) y from v_bars)
    where (ticker, y) not in (select ticker, year(date) from v_bars where volume >= 100)
    """,
)
def coverage_gaps(spark, d):
    """Instrument-years that have no bar of at least 100 shares."""
    bars = I.bars(spark, d).select("ticker", F.year("date").alias("year"), "volume")
    span = bars.agg(F.sequence(F.min("year"), F.max("year")).alias("years"))
    expected = I.instruments(spark, d).select("ticker", F.explode(span.scalar()).alias("year"))
    return C.missing_keys(expected, bars.filter("volume >= 100"), ["ticker", "year"])


@query(
    "duplicate_line_keys",
    "select l_orderkey, l_linenumber, count(*) row_count from lineitem group by 1, 2 having count(*) > 1",
)
def duplicate_line_keys(spark, d):
    return C.duplicate_keys(I.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "missing_optional_layer",
    "select ticker, cast(null as double) score, count(*) bars from v_bars group by 1",
)
def missing_optional_layer(spark, d):
    """An absent optional input joins as a typed empty table."""
    layer = C.optional(None, spark, "ticker string, score double")
    counts = I.bars(spark, d).groupBy("ticker").agg(F.count(F.lit(1)).alias("bars"))
    return counts.join(layer, "ticker", "left").select("ticker", "score", "bars")


@query(
    "page_symbols",
    """
    select upper(s) symbol, count(distinct page_id) pages
    from (select page_id, unnest(regexp_extract_all(html, 'href="/([A-Za-z]{3,})"', 1)) s from pages) group by 1
    """,
)
def page_symbols(spark, d):
    found = I.table(spark, d, "pages").select(
        "page_id", F.explode(X.attribute_symbols(F.col("html"), r'href="/([A-Za-z]{3,})"')).alias("symbol")
    )
    return found.groupBy("symbol").agg(F.count(F.lit(1)).alias("pages"))


@query(
    "page_script_members",
    r"""
    select page_id, unnest([cast(x as bigint) for x in regexp_extract_all(html, 'track\((\d+)\)', 1)]) member from pages
    """,
)
def page_script_members(spark, d):
    """Members named inside embedded scripts, all of them, read through a JSON payload."""
    found = F.regexp_extract_all("html", F.lit(r"track\((\d+)\)"), 1)
    payload = F.concat(F.lit('{"list":['), F.array_join(found, ","), F.lit("]}"))
    members = F.from_json(payload, "list array<bigint>")["list"]
    return I.table(spark, d, "pages").select("page_id", F.explode(members).alias("member"))


@query(
    "listing_json_filter",
    """
    select upper(event_type) code, count(*) listings from events
    where cast(json_extract(props, '$.k') as int) >= 50 group by 1
    """,
)
def listing_json_filter(spark, d):
    parsed = I.table(spark, d, "events").select("event_type", F.from_json("props", "k int").alias("p"))
    return (
        parsed.filter("p.k >= 50").groupBy(F.upper("event_type").alias("code")).agg(F.count(F.lit(1)).alias("listings"))
    )


@query(
    "page_sector_levels",
    """
    with t as (select page_id, list_filter(list_transform(regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1),
        '<a [^>]*>([^<]*)</a>', 1), lambda x: trim(x)), lambda x: x <> '') lv from pages)
    select page_id, lv[1] top, lv[-1] leaf, array_to_string(lv, ' / ') path from t where len(lv) > 0
    """,
)
def page_sector_levels(spark, d):
    levels = I.table(spark, d, "pages").select("page_id", X.anchor_levels(F.col("html")).alias("lv"))
    return levels.filter(F.size("lv") > 0).select(
        "page_id", F.get("lv", F.lit(0)).alias("top"), F.element_at("lv", -1).alias("leaf"), F.array_join("lv", " / ").alias("path")
    )


@query(
    "page_label_values",
    """
    with t as (select page_id, regexp_extract_all(html, '<a href="/([^"]*)">([^<]*)</a>', 1) ks,
                 regexp_extract_all(html, '<a href="/([^"]*)">([^<]*)</a>', 2) vs from pages),
    e as (select page_id, unnest(ks) k, unnest(vs) v, unnest(range(len(ks))) i from t)
    select page_id, trim(k) label, arg_max(trim(v), i) "value" from e where trim(k) <> '' group by 1, 2
    """,
)
def page_label_values(spark, d):
    pairs = X.label_value_map(F.col("html"), r'<a href="/([^"]*)">([^<]*)</a>')
    return I.table(spark, d, "pages").select("page_id", F.explode(pairs).alias("label", "value"))


@query(
    "fundamental_ratios",
    """
    with e as (select c_nationkey k, avg(c_acctbal) eps from customer group by 1),
    b as (select s_nationkey k, avg(s_acctbal) bvps from supplier group by 1),
    p as (select ticker, arg_max(close, date) / 1000000.0 price from v_bars group by 1)
    select ticker, price, round(price / nullif(eps, 0), 6) pe, round(price / nullif(bvps, 0), 6) pb,
      round(eps / nullif(bvps, 0) * 100, 6) roe
    from v_inst join p using (ticker) left join e on e.k = n_nationkey left join b on b.k = n_nationkey
    """,
)
def fundamental_ratios(spark, d):
    eps = I.table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.avg("c_acctbal").alias("eps"))
    book = I.table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.avg("s_acctbal").alias("bvps"))
    price = I.bars(spark, d).groupBy("ticker").agg((F.max_by("close", "date") / I.PRICE_UNIT).alias("price"))
    joined = I.instruments(spark, d).join(price, "ticker").join(eps, "n_nationkey", "left").join(book, "n_nationkey", "left")
    out = S.fundamental_ratios(joined)
    return out.select("ticker", "price", *[F.round(c, 6).alias(c) for c in ("pe", "pb", "roe")])


@query(
    "normalized_names",
    """
    select upper(trim(raw)) ticker, min(pos) first_position
    from (select case s_suppkey % 4 when 0 then '  ' || lower(n_name) when 1 then n_name || ' ' when 2 then 'vn30' else ' ' end raw,
            s_suppkey pos from supplier join nation on s_nationkey = n_nationkey)
    where trim(raw) <> '' and not regexp_matches(upper(trim(raw)), 'VNINDEX|VN30|VN100') group by 1
    """,
)
def normalized_names(spark, d):
    kind = F.col("s_suppkey") % 4
    raw = (
        I.table(spark, d, "supplier")
        .join(I.table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.when(kind == 0, F.concat(F.lit("  "), F.lower("n_name")))
            .when(kind == 1, F.concat("n_name", F.lit(" ")))
            .when(kind == 2, "vn30")
            .otherwise(" ")
            .alias("raw"),
            F.col("s_suppkey").alias("pos"),
        )
    )
    return U.normalize_names(raw, "raw", "pos")


@query(
    "universe_resolved",
    """
    select ticker from v_inst where sector <> 'AFRICA' union select ticker from v_pos where quantity <> 0
    """,
)
def universe_resolved(spark, d):
    mapped = I.instruments(spark, d).filter("sector <> 'AFRICA'")
    return U.resolve_universe(mapped, I.positions(spark, d).filter("quantity <> 0"))


@query(
    "universe_allow_list",
    "select ticker from v_inst where ticker in (select ticker from v_pos where quantity > 0)",
)
def universe_allow_list(spark, d):
    held = I.positions(spark, d)
    return U.resolve_universe(I.instruments(spark, d), held, allow=held.filter("quantity > 0"))


@query(
    "sector_copy",
    """
    with extra as (select s_name ticker, n_name source from supplier join nation on s_nationkey = n_nationkey)
    select ticker, sector from v_inst
    union all select e.ticker, i.sector from extra e left join v_inst i on i.ticker = e.source
    """,
)
def sector_copy(spark, d):
    """Suppliers forced into the universe take the sector of their nation."""
    extra = (
        I.table(spark, d, "supplier")
        .join(I.table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(F.col("s_name").alias("ticker"), F.array(F.lit("NONE"), F.col("n_name")).alias("sources"))
    )
    return U.add_with_copied_sector(I.instruments(spark, d), extra, "sources")


@query(
    "sector_lookup_split",
    """
    select ticker, coalesce(m.sector, 'Unknown') sector, case when m.sector is null then 'missing' else 'cached' end lookup
    from (select ticker from v_inst union select upper(event_type) from events) t
      left join (select ticker, sector from v_inst where sector <> 'EUROPE') m using (ticker)
    """,
)
def sector_lookup_split(spark, d):
    inst = I.instruments(spark, d)
    names = inst.select("ticker").union(I.table(spark, d, "events").select(F.upper("event_type"))).distinct()
    return U.assign_sector(names, inst.filter("sector <> 'EUROPE'").select("ticker", "sector"))


@query(
    "label_normalisation",
    """
    select doc_id, trim(regexp_replace(translate(lower(trim(text)), '{accented}', '{plain}'), '[^a-z0-9]+', ' ', 'g')) label
    from documents
    """.replace("{accented}", X.ACCENTED).replace("{plain}", X.PLAIN),
)
def label_normalisation(spark, d):
    return I.table(spark, d, "documents").select("doc_id", X.plain_label(F.col("text")).alias("label"))


@query(
    "number_normalisation",
    """
    select l_orderkey, l_linenumber, l_suppkey, l_partkey, case when l_returnflag = 'R' then -l_extendedprice
      when l_returnflag = 'A' then l_extendedprice end "value" from lineitem
    """,
)
def number_normalisation(spark, d):
    """Amounts written in report style (grouped digits, negatives in brackets, dashes) back to numbers."""
    amount = F.format_number("l_extendedprice", 2)
    text = (
        F.when(F.col("l_returnflag") == "R", F.concat(F.lit("("), amount, F.lit(")")))
        .when(F.col("l_returnflag") == "A", F.concat(F.lit(" "), amount, F.lit(" %")))
        .otherwise("-")
    )
    return I.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", X.parse_number(text).alias("value")
    )


@query(
    "note_overrides",
    """
    with n as (select conv_id, turn, upper(role) || cast(conv_id % 7 as varchar) ticker, conv_id % 100 + turn + 0.5 target_price,
                 cast(2020 + turn % 5 as int) target_year from conversations where role <> 'system')
    select ticker, arg_max(target_price, (conv_id, turn)) target_price, arg_max(target_year, (conv_id, turn)) target_year
    from n group by 1
    """,
)
def note_overrides(spark, d):
    """Bullet notes to per-instrument overrides; the last note of an instrument wins."""
    name = F.concat(F.upper("role"), (F.col("conv_id") % 7).cast("string"))
    line = F.concat(
        F.when(F.col("role") == "system", "").otherwise("- "),
        F.lit("mua `"), name, F.lit("` Target giá "), (F.col("conv_id") % 100 + F.col("turn") + 0.5).cast("string"),
        F.lit(" năm "), (F.lit(2020) + F.col("turn") % 5).cast("string"),
    )
    notes = I.table(spark, d, "conversations").select("conv_id", "turn", line.alias("line"))
    fields = X.note_overrides(F.col("line"))
    parsed = notes.select(F.struct("conv_id", "turn").alias("at"), *[c.alias(n) for n, c in fields.items()])
    return B.upsert_keep_last(parsed.filter("ticker is not null"), ["ticker"], "at")
