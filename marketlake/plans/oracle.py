"""DuckDB SQL for every registered query, independent of the engine.

Nothing is imported from the engine: rules, accepted values, check columns and
the list of data tests are written out here again.  Fixture views come first,
then each model from its definition, by other means than the engine's: newest
loads by ``arg_max``, earlier closes by an as-of join, rolling moments by a
self-join on row numbers.  Doubles are rounded to 9 places (+ 0.0 to fold -0.0)
on both sides.
"""

from __future__ import annotations

J = "json_extract_string(props,'$.k')"


def SEED_SYM(n: str, s: str) -> str:
    return (f"case when {n}=7 then 'BRK{s}B' when {n}%7=0 then concat('U',{n},'{s}B') "
            f"else concat('U',{n}) end")


def SYM(n: str, s: str) -> str:
    return f"if({n} % 10 = 0, concat('N', {n}), {SEED_SYM(n, s)})"


def SAFE_DIV(n: str, d: str) -> str:
    return f"(case when ({d}) is null or ({d}) = 0 then null else ({n}) / ({d}) end)"


# Words of an industry and their sector; the first found in this order counts.
INDUSTRY_WORDS = [
    ("technology", "Technology"),
    ("health", "Healthcare"),
    ("pharma", "Healthcare"),
    ("biotech", "Healthcare"),
    ("bank", "Financials"),
    ("insurance", "Financials"),
    ("financial", "Financials"),
    ("consumer cyclical", "Consumer Discretionary"),
    ("retail", "Consumer Discretionary"),
    ("automobile", "Consumer Discretionary"),
    ("restaurant", "Consumer Discretionary"),
    ("consumer defensive", "Consumer Staples"),
    ("beverage", "Consumer Staples"),
    ("household", "Consumer Staples"),
    ("industrial", "Industrials"),
    ("aerospace", "Industrials"),
    ("transport", "Industrials"),
    ("energy", "Energy"),
    ("oil", "Energy"),
    ("gas", "Energy"),
    ("communication", "Communication Services"),
    ("media", "Communication Services"),
    ("entertainment", "Communication Services"),
    ("telecom", "Communication Services"),
    ("utility", "Utilities"),
    ("real estate", "Real Estate"),
    ("material", "Materials"),
    ("chemical", "Materials"),
]
_RULES = ", ".join(f"({k}, '{word}', '{sector}')" for k, (word, sector) in enumerate(INDUSTRY_WORDS))


def CLASSIFY(col: str) -> str:
    return (f"coalesce((select arg_min(rule.sector, rule.place) from (values {_RULES}) as rule(place, word, sector) "
            f"where contains(lower({col}), rule.word)), 'Financials')")


ACCEPTED = ", ".join(f"'{s}'" for s in sorted({sector for _, sector in INDUSTRY_WORDS}))

# The columns whose change opens a new profile version.
PROFILE_COLUMNS = "company_name exchange industry country market_cap ipo_date logo_url web_url sector".split()

# The data tests declared for each model: not_null / unique columns, keys, and the others.
MODEL_TESTS = {
    "stg_candles": {"not_null": "symbol date_key close volume", "key": "symbol date_key"},
    "stg_company_profiles": {"not_null": "symbol sector", "unique": "symbol", "sectors": "sector"},
    "stg_company_news": {"not_null": "symbol news_ts"},
    "stg_company_financials": {"not_null": "symbol date_key", "key": "symbol date_key"},
    "int_daily_returns": {"not_null": "symbol date_key daily_return"},
    "int_volume_stats": {"not_null": "symbol date_key", "key": "symbol date_key"},
    "dim_companies": {"not_null": "symbol sector", "unique": "symbol", "sectors": "sector"},
    "dim_dates": {"not_null": "date_key", "unique": "date_key"},
    "fct_daily_prices": {"not_null": "symbol date_key close volume", "key": "symbol date_key", "star": True, "close": (0, 100000),
                         "volume": True, "returns": True},
    "fct_company_news": {"not_null": "news_id symbol date_key", "unique": "news_id", "star": True},
    "fct_company_financials": {"not_null": "symbol date_key", "key": "symbol date_key", "star": True},
    "sector_performance": {"not_null": "date_key sector cumulative_return"},
    "sector_volatility": {"not_null": "sector annualized_volatility", "unique": "sector"},
}

# --- fixture views ---------------------------------------------------------
CTES: dict[str, str] = {}

CTES["fx_candles"] = f"""
select event_id,
  case event_id%3 when 0 then concat(' ',lower({SYM('user_id','.')}),' ')
                  when 1 then lower({SYM('user_id','.')}) else {SYM('user_id','.')} end as symbol,
  cast(ts as date) as trading_date, value as open, value+1 as high, greatest(value-1,0.01) as low,
  case when event_type='error' then null else value end as close,
  cast({J} as double)*0.5 as volume, ts as _loaded_at
from events"""

CTES["fx_candles_long"] = """
select o_orderkey as event_id, concat('C',o_custkey) as symbol, cast(o_orderdate as date) as trading_date,
  o_totalprice as open, o_totalprice as high, o_totalprice as low, o_totalprice as close,
  cast(o_orderkey%100 as double) as volume, o_orderdate as _loaded_at
from orders"""

CTES["fx_sector_map"] = f"""
select {SEED_SYM('c_custkey','.')} as symbol, r_name as sector
from customer join nation on c_nationkey=n_nationkey join region on n_regionkey=r_regionkey"""

CTES["fx_candles_scale"] = """
select l_orderkey*8 + l_linenumber as event_id, concat('S', l_suppkey) as symbol,
  cast(l_shipdate as date) as trading_date, l_extendedprice/l_quantity as open,
  (l_extendedprice/l_quantity) * (1 + l_tax) as high, (l_extendedprice/l_quantity) * (1 - l_discount) as low,
  l_extendedprice/l_quantity as close, l_quantity as volume, l_shipdate as _loaded_at
from lineitem"""

CTES["fx_sector_map_scale"] = """
select concat('S', s_suppkey) as symbol, r_name as sector
from supplier join nation on s_nationkey=n_nationkey join region on n_regionkey=r_regionkey"""

CTES["fx_profiles"] = f"""
select {SYM('c_custkey','-')} as symbol, c_name as company_name,
  case when c_custkey%11=0 then null when c_custkey%13=0 then 'Biotechnology'
       when c_custkey%17=0 then 'Utilities' else c_mktsegment end as industry,
  n_name as country, c_acctbal as market_cap, '2001-02-03' as ipo_date, 'X' as exchange,
  concat('L',c_custkey) as logo_url, concat('W',c_custkey) as web_url,
  timestamp '2024-01-31 00:00:00' as _loaded_at
from customer join nation on c_nationkey=n_nationkey"""

CTES["fx_news"] = f"""
select event_id, {SYM('user_id','.')} as symbol, date_trunc('hour', ts) as datetime,
  event_type as headline, concat('S', event_id%7) as summary, concat('src',event_id%5) as source,
  event_type as category,
  case when event_id%4=0 then null else concat('http://x/', {J}) end as url,
  cast(null as varchar) as image, ts as _loaded_at
from events"""

CTES["fx_financials"] = f"""
select event_id, {SYM('user_id','-')} as symbol, value as pe_ratio, value/2 as pb_ratio,
  value/10 as eps_ttm, cast({J} as double)/100 as dividend_yield, 1.0::double as beta,
  case when event_id%2=0 then cast({J} as double) end as "52_week_high",
  case when event_id%2=1 then cast({J} as double) end as week_52_high,
  case when event_id%2=0 then cast({J} as double)/2 end as "52_week_low",
  case when event_id%2=1 then cast({J} as double)/2 end as week_52_low,
  value*1000 as market_cap, ts as _loaded_at
from events"""


# --- models --------------------------------------------------------------------
def _newest(src: str, group: dict[str, str], fields: dict[str, str], order: list[str]) -> str:
    """One row a group: the fields of the row whose order values are greatest, a NULL counting as least."""
    packed = ", ".join(f"{name} := {expr}" for name, expr in fields.items())
    least = {"_loaded_at": "timestamp '0001-01-01'", "company_name": "''"}
    rank = ", ".join(f"k{i} := coalesce({col}, {least.get(col, '-1')})" for i, col in enumerate(order))
    keys = ", ".join(f"{expr} as {name}" for name, expr in group.items())
    return f"select {', '.join(group)}, unnest(newest) from (select {keys}, arg_max(struct_pack({packed}), struct_pack({rank})) as newest from {src} group by all)"


KEY = "upper(trim(symbol))"
FOLDED = f"if({KEY} = 'BRK-B', 'BRK.B', {KEY})"


def _stg_candles(src: str, *more_order: str) -> str:
    prices = {c: f"cast({c} as double)" for c in ("open", "high", "low", "close")}
    newest = _newest(src, {"symbol": KEY, "date_key": "cast(trading_date as date)"},
                     {**prices, "volume": "cast(round(volume) as bigint)", "_loaded_at": "_loaded_at"}, ["_loaded_at", "event_id", *more_order])
    return f"select * from ({newest}) as loads where symbol is not null and close is not null and volume >= 1"


CTES["stg_candles"] = _stg_candles("fx_candles")
CTES["stg_candles_long"] = _stg_candles("fx_candles_long")
CTES["stg_candles_scale"] = _stg_candles("fx_candles_scale", "open", "high", "low", "close", "volume")


def _returns(stg: str) -> str:
    return f"""
select now.symbol, now.date_key, now.open, now.high, now.low, now.close, now.volume,
  (now.close - ago.close) / nullif(ago.close, 0) as daily_return,
  if(least(now.close, ago.close) > 0, ln(now.close / ago.close), null) as log_return, now._loaded_at
from {stg} as now asof join {stg} as ago on now.symbol = ago.symbol and now.date_key > ago.date_key"""


def _volume_stats(stg: str) -> str:
    """Moments of the last twenty rows from exact integer sums."""
    return f"""
with numbered as (select symbol, date_key, volume, rank() over (partition by symbol order by date_key) as place from {stg}),
sums as (
  select now.symbol, now.date_key, any_value(now.volume) as volume, count(*) as n,
    sum(ago.volume) as s, sum(cast(ago.volume as hugeint) * ago.volume) as q
  from numbered as now join numbered as ago on ago.symbol = now.symbol and ago.place between now.place - 19 and now.place
  group by now.symbol, now.date_key),
moments as (select symbol, date_key, volume, s / n as mean, sqrt(cast(n * q - s * s as double)) / n as spread from sums)
select symbol, date_key, volume, mean as volume_sma_20, spread as volume_stddev_20,
  (volume - mean) / nullif(spread, 0) as volume_zscore
from moments"""


CTES["int_daily_returns"] = _returns("stg_candles")
CTES["int_volume_stats"] = _volume_stats("stg_candles")


def _aliases(seed: str) -> str:
    """A seed symbol under every spelling of its share class."""
    return f"""
select distinct unnest([spelled, translate(spelled, '.', '-'), translate(spelled, '-', '.')]) as symbol_key, sector
from (select {KEY} as spelled, sector from {seed}) as seeded"""


CTES["sector_map_aliases"] = _aliases("fx_sector_map")

_PROFILE = {c: c for c in ("company_name", "industry", "country", "market_cap", "ipo_date", "logo_url", "web_url", "exchange", "_loaded_at")}

CTES["stg_company_profiles"] = f"""
select p.symbol, company_name,
  coalesce((select any_value(sector) from sector_map_aliases as named where named.symbol_key = p.symbol), {CLASSIFY('industry')}) as sector,
  industry, country, cast(market_cap as double) as market_cap, try_cast(ipo_date as date) as ipo_date,
  logo_url, web_url, exchange, _loaded_at
from ({_newest('fx_profiles', {'symbol': KEY}, _PROFILE, ['_loaded_at', 'company_name'])}) as p where p.symbol is not null"""


def _dim_companies(seed: str, profiles: str) -> str:
    """Every seed symbol, with its newest profile where there is one."""
    return f"""
with profiled as ({_newest(profiles, {'symbol': FOLDED}, _PROFILE, ['_loaded_at', 'company_name'])})
select symbol, coalesce(company_name, symbol) as company_name, sector, industry, country, market_cap, ipo_date, logo_url, web_url,
  exchange, _loaded_at
from profiled right join (select {KEY} as symbol, sector from {seed}) as seeded using (symbol)"""


CTES["dim_companies"] = _dim_companies("fx_sector_map", "stg_company_profiles")


def _fct_daily_prices(returns: str, companies: str, vstats: str) -> str:
    return f"""
with grown as (
  select *, coalesce(sum(log_return) over (partition by symbol order by date_key), 0) as total from {returns})
select symbol, date_key, (select any_value(sector) from {companies} as c where c.symbol = grown.symbol) as sector,
  open, high, low, close, grown.volume, daily_return, log_return, exp(total) - 1 as cumulative_return,
  volume_sma_20, volume_zscore, _loaded_at
from grown left join (select symbol, date_key, volume_sma_20, volume_zscore from {vstats}) as stats using (symbol, date_key)"""


CTES["fct_daily_prices"] = _fct_daily_prices("int_daily_returns", "dim_companies", "int_volume_stats")


def _sector_daily(fact: str) -> str:
    return f"""
select date_key, sector, sum(daily_return) / count(daily_return) as avg_daily_return, sum(log_return) / count(log_return) as avg_log_return
from {fact} group by all having sector is not null"""


CTES["sector_daily"] = _sector_daily("fct_daily_prices")

CTES["sector_performance"] = """
with grown as (select *, exp(coalesce(sum(avg_log_return) over (partition by sector order by date_key), 0)) as growth from sector_daily)
select date_key, sector, avg_daily_return, 100 * avg_daily_return as avg_daily_return_pct, growth - 1 as cumulative_return,
  100 * (growth - 1) as cumulative_return_pct
from grown"""


def sector_volatility_sql(as_of: str, fact: str = "fct_daily_prices") -> str:
    return f"""
with recent as (select sector, daily_return as x from {fact} where date_key >= date '{as_of}' - to_months(12) and sector is not null),
centre as (select sector, sum(x) / count(x) as mean from recent group by sector),
spread as (select sector, any_value(mean) as mean, sqrt(sum((x - mean) ** 2) / count(x)) as deviation from recent join centre using (sector) group by sector)
select sector, 252 * mean as annualized_return, sqrt(252) * deviation as annualized_volatility,
  252 * mean / nullif(sqrt(252) * deviation, 0) as return_risk_ratio
from spread"""


_RATIOS = {c: f"cast({c} as double)" for c in ("pe_ratio", "pb_ratio", "eps_ttm", "dividend_yield", "beta")}
_RATIOS |= {f"week_52_{end}": f"cast(coalesce(\"52_week_{end}\", week_52_{end}) as double)" for end in ("high", "low")}

CTES["stg_company_financials"] = "select * from (" + _newest(
    "fx_financials", {"symbol": FOLDED, "date_key": "cast(_loaded_at as date)"},
    {**_RATIOS, "market_cap": "cast(market_cap as double)", "_loaded_at": "_loaded_at"}, ["_loaded_at", "event_id"]) + ") as loads where symbol is not null"

_STORY = {c: c for c in ("headline", "summary", "source", "category", "url", "image", "_loaded_at")}

CTES["stg_company_news"] = "select news.* exclude (story), cast(news_ts as date) as date_key from (" + _newest(
    "fx_news", {"symbol": KEY, "news_ts": "datetime", "story": "coalesce(url, headline)"}, _STORY, ["_loaded_at", "event_id"]
) + ") as news where symbol is not null and news_ts is not null"

# Fixed value: what stands for a NULL in the key's hash.
NO_VALUE = "_dbt_utils_surrogate_key_null_"
NEWS_ID = ("md5(array_to_string(list_transform([cast(symbol as varchar), strftime(news_ts, '%Y-%m-%d %H:%M:%S.%f'), "
           f"cast(headline as varchar), cast(url as varchar)], lambda part: coalesce(part, '{NO_VALUE}')), '-'))")

CTES["fct_company_news"] = f"""
select {NEWS_ID} as news_id, symbol, date_key, news_ts, headline, summary, source, category, url, image, _loaded_at from stg_company_news"""

CTES["fct_company_financials"] = "from stg_company_financials"

CTES["all_dates"] = "select unnest([(select list(date_key) from stg_candles), (select list(date_key) from stg_company_financials), (select list(date_key) from stg_company_news)], recursive := true) as date_key"


def date_bounds_sql(as_of: str) -> str:
    return f"""
select ifnull(min(date_key), date '{as_of}' - 365) as min_date, ifnull(max(date_key), date '{as_of}') as max_date from all_dates"""


CTES["date_spine"] = """
select min_date + cast(day as integer) as date_key from date_bounds, unnest(range(max_date - min_date + 1)) as days(day)"""

CTES["trading_days"] = "select date_key from stg_candles group by date_key"

CTES["dim_dates"] = """
select date_key, date_part('year', date_key) as year, date_part('quarter', date_key) as quarter, date_part('month', date_key) as month,
  date_part('week', date_key) as week_of_year, date_part('isodow', date_key) % 7 + 1 as day_of_week,
  date_key in (select date_key from stg_candles) as is_trading
from date_spine"""

# long-range star (lineitem, 1992-1998): multi-year series for 12-month and monthly metrics
CTES["int_daily_returns_scale"] = _returns("stg_candles_scale")
CTES["int_volume_stats_scale"] = _volume_stats("stg_candles_scale")
CTES["dim_companies_scale"] = _dim_companies("fx_sector_map_scale", "stg_company_profiles")
CTES["fct_daily_prices_scale"] = _fct_daily_prices("int_daily_returns_scale", "dim_companies_scale",
                                                   "int_volume_stats_scale")
CTES["sector_daily_scale"] = _sector_daily("fct_daily_prices_scale")


# --- assembly ---------------------------------------------------------------
def _deps(sql: str, known: dict[str, str]) -> list[str]:
    import re
    words = set(re.findall(r"[A-Za-z_][A-Za-z0-9_]*", sql))
    return [n for n in known if n in words]


def build(body: str, extra: dict[str, str] | None = None, round_cols=(), order_free: bool = True) -> str:
    """WITH-clause with every CTE the body needs (transitively, in order)."""
    known = dict(CTES)
    if extra:
        known.update(extra)
    order: list[str] = []

    def visit(name: str, seen: tuple = ()):
        if name in order:
            return
        for d in _deps(known[name], known):
            if d != name and d not in seen:
                visit(d, seen + (name,))
        order.append(name)

    for d in _deps(body, known):
        visit(d)
    with_clause = ""
    if order:
        with_clause = "with " + ",\n".join(f"{n} as ({known[n]}\n)" for n in order) + "\n"
    if round_cols:
        repl = ", ".join(f"round({c}, 9) + 0.0 as {c}" for c in round_cols)
        body = f"select * replace ({repl}) from ({body}) q"
    return with_clause + body


# --- sources -------------------------------------------------------------------
LOADED = "timestamp '2024-02-01 00:00:00'"

CTES["fx_fallback_bars"] = f"""
select event_id, {SYM('user_id','.')} as symbol, cast(ts as date) as "Date", value as "Open",
  value+1 as "High", greatest(value-1,0.01) as "Low",
  case when event_type='error' then null else value end as "Close",
  case when event_type='error' then null else cast({J} as double)*0.5 end as "Volume",
  user_id
from events"""

CTES["flat_candles"] = f"""
select {SYM('user_id','.')} as symbol, cast(ts as date) + cast(i as integer) as trading_date,
  value + i as open,
  case i when 0 then value + 1 when 1 then value + 2 else value + 3 end as high,
  case i when 0 then value - 1 when 1 then value else value + 1 end as low,
  case i when 0 then value when 1 then value + 0.5 else value + 1.5 end as close,
  cast({J} as double) + i as volume, {LOADED} as _loaded_at, user_id
from events, range(3) r(i)
where event_type not in ('signup', 'error') and not (event_type = 'purchase' and event_id % 10 = 0)"""

CTES["fallback_candles"] = f"""
select symbol, replace(symbol, '.', '-') as provider_ticker, "Date" as trading_date,
  coalesce("Open", 0.0) as open, coalesce("High", 0.0) as high, coalesce("Low", 0.0) as low,
  coalesce("Close", 0.0) as close, cast(trunc(coalesce("Volume", 0.0)) as bigint) as volume,
  {LOADED} as _loaded_at
from fx_fallback_bars"""


def _failures(model: str, name: str, spec) -> list[tuple[str, str, str]]:
    """(test, column, query that counts failures) of one entry of MODEL_TESTS."""
    if name == "not_null":
        return [("not_null", c, f"select count(*) - count({c}) from {model}") for c in spec.split()]
    if name == "unique":
        return [("unique", c, f"select count(*) from (select 1 from {model} where {c} is not null group by {c} having count(*) > 1) as d") for c in spec.split()]
    if name == "key":
        keys = ",".join(spec.split())
        return [("unique_combination", keys, f"select count(*) from (select 1 from {model} group by {keys} having count(*) > 1) as d")]
    if name == "sectors":
        return [("accepted_values", spec, f"select count(distinct {spec}) from {model} where {spec} not in ({ACCEPTED})")]
    if name == "star":
        return [("relationships", c, f"select count(*) from {model} anti join {dim} using ({c}) where {c} is not null")
                for c, dim in (("symbol", "dim_companies"), ("date_key", "dim_dates"))]
    if name == "close":
        return [("between", "close", f"select count(*) from {model} where close < {spec[0]} or close > {spec[1]}")]
    if name == "volume":
        return [("assert_positive_volume", "volume", f"select count(*) from {model} where volume < 1")]
    return [("assert_valid_return_range", "daily_return", f"select count(*) from {model} where abs(daily_return) > 0.5")]


def suite_sql() -> str:
    """Every declared test with its number of failures."""
    rows = [f"select '{model}' as model, '{test}' as test, '{column}' as column_name, cast(({query}) as bigint) as failures"
            for model, tests in MODEL_TESTS.items() for name, spec in tests.items() for test, column, query in _failures(model, name, spec)]
    return f"select *, if(failures = 0, 'pass', 'fail') as status from ({' union all '.join(rows)}) as tested"
