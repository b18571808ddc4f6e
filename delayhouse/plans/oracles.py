"""SQL over the given tables that each registered query must equal.

The statements are written from the tables up and share nothing with the DataFrame code. ``_CTES`` holds
named subqueries; a statement gets those it mentions, directly or through others.
"""

from __future__ import annotations

import re

_ISO = (
    "coalesce(try_cast(regexp_extract({c}, '(\\d+)H', 1) as integer), 0) * 60"
    " + coalesce(try_cast(regexp_extract({c}, '(\\d+)M', 1) as integer), 0)"
)
_UUID = (
    "substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-'"
    " || substr('89ab', (instr('0123456789abcdef', substr({h}, 17, 1)) - 1) % 4 + 1, 1) || substr({h}, 18, 3)"
    " || '-' || substr({h}, 21, 12)"
)


def _iso(column: str) -> str:
    return _ISO.format(c=column)


def _uuid(name: str) -> str:
    return _UUID.format(h=f"sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode({name}))")


def _percent(num: str, den: str, digits: int) -> str:
    """100 * num / den, half up, in integers."""
    scale = 10**digits
    return (
        f"cast((2 * {scale} * 100 * cast({num} as bigint) + {den}) // nullif(2 * cast({den} as bigint), 0) as double)"
        f" / {scale}.0"
    )


def _ratio(num: str, den: str, digits: int) -> str:
    scale = 10**digits
    return (
        f"cast((2 * {scale} * cast({num} as bigint) + {den}) // nullif(2 * cast({den} as bigint), 0) as double)"
        f" / {scale}.0"
    )


def _minutes_between(a: str, b: str) -> str:
    return f"cast(round((epoch_us({a}) - epoch_us({b})) / 60e6) as integer)"


def _place(side: str, number: str) -> str:
    return f"""
        'N' || {number} as {side}_airport_code, 'Airport ' || {number} as {side}_airport_name,
        'C' || ({number} % 20) as {side}_city_code, 'City ' || ({number} % 20) as {side}_city_name,
        'R' || ({number} % 5) as {side}_country_code, 'Country ' || ({number} % 5) as {side}_country_name"""


_CTES = {
    "flights": """
        select cast(o_orderkey as varchar) as id, cast(o_custkey as integer) as flight_number,
            strftime(o_orderdate, '%Y-%m-%d') as flight_schedule_date,
            substr(o_orderpriority, 1, 1) as airline_code,
            case when o_custkey % 97 = 0 then lower(o_orderpriority) else o_orderpriority end as airline_name,
            case when o_totalprice > 250000 then 'LONG' else 'MEDIUM' end as haul,
            cast(null as varchar) as route, o_orderstatus as flight_status_public,
            timestamp '2002-01-01 06:00:00' as fetched_at
        from orders""",
    "items": """
        select *, cast(l_quantity as integer) as q, l_returnflag = 'R' and l_quantity > 40 as is_cancelled,
            concat_ws('_', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y%m%d')) as leg_key,
            case when l_quantity <> 50 then case when l_suppkey % 3 = 0 then 0 else l_suppkey % 25 end end as dep_n,
            (l_suppkey + l_partkey) % 25 as arr_n,
            l_shipdate + to_hours(2 * l_linenumber) as dep_at, cast(1 + l_partkey % 9 as integer) as hours
        from lineitem""",
    "timed": """
        select *, case when q <> 49 then dep_at end as sched_dep,
            case when not is_cancelled
                then dep_at + to_minutes(q - 20) + to_seconds(cast(l_partkey % 50 as integer) - 10) end as act_dep
        from items""",
    "legs": f"""
        select leg_key as id, cast(l_orderkey as varchar) as flight_id,
            cast(l_linenumber - 1 as integer) as leg_order,
            {_place("departure", "dep_n")}, {_place("arrival", "arr_n")},
            case when is_cancelled then 'CANCELLED' else 'ARRIVED' end as published_status,
            sched_dep as scheduled_departure, act_dep as actual_departure,
            sched_dep + to_hours(hours) as scheduled_arrival,
            act_dep + to_hours(hours) + to_minutes(q - 25) as actual_arrival,
            'PT' || hours || 'H' || case when q % 4 = 0 then '' else q || 'M' end as scheduled_flight_duration,
            is_cancelled as cancelled,
            'A' || (l_partkey % 40) as aircraft_code, 'Aircraft ' || (l_partkey % 40) as aircraft_name
        from timed""",
    "delays": """
        select leg_key || '_0' as id, leg_key as flight_leg_id,
            case when l_returnflag <> 'N' then 'C' || l_linenumber end as delay_code,
            cast(null as varchar) as delay_reason,
            case when l_returnflag = 'N' then '00' when q < 10 then null
                when q % 2 = 0 then 'PT' || q || 'M' else 'PT' || (q % 3) || 'H' || q || 'M' end as delay_duration
        from items
        union all
        select leg_key || '_1', leg_key, 'C9', null, 'PT' || q || 'M' from items
        where l_returnflag = 'A' and q % 5 = 0""",
    "predictions": """
        select leg_key as leg_id, cast(l_orderkey as varchar) as flight_id,
            case when q % 3 = 0 then 1 else 0 end as delay_predicted,
            timestamp '2002-01-01 06:00:00' as "timestamp"
        from items where not is_cancelled and (l_partkey + l_linenumber) % 3 <> 0""",
    "joined": """
        select l.id as leg_id, l.* exclude (id), f.flight_number, f.flight_schedule_date, f.airline_code,
            f.airline_name
        from legs l join flights f on l.flight_id = f.id""",
    "delay_sums": f"""
        select flight_leg_id, cast(sum({_iso("delay_duration")}) as integer) as delay_duration_minutes,
            min(delay_code) as delay_code
        from delays where delay_duration is not null group by flight_leg_id""",
    "leg_delays": f"""
        select j.*, {_minutes_between("actual_departure", "scheduled_departure")} as departure_delay_minutes,
            {_minutes_between("actual_arrival", "scheduled_arrival")} as arrival_delay_minutes,
            d.delay_code, d.delay_duration_minutes
        from joined j left join delay_sums d on j.leg_id = d.flight_leg_id""",
    "outcomes": f"""
        select *, {_iso("scheduled_flight_duration")} as scheduled_flight_duration_minutes,
            cast(extract(dow from scheduled_departure) as integer) as departure_weekday,
            cast(extract(month from scheduled_departure) as integer) as departure_month,
            cast(extract(hour from scheduled_departure) as integer) as departure_hour,
            cast(extract(day from scheduled_departure) as integer) as departure_monthday,
            coalesce(departure_delay_minutes, 0) >= 15 or coalesce(arrival_delay_minutes, 0) >= 15
                or coalesce(delay_duration_minutes, 0) >= 15 as is_delayed
        from leg_delays""",
    "facts": """
        select leg_id, flight_id, flight_number, airline_code as airline_key, airline_name,
            departure_airport_code as departure_airport_key, arrival_airport_code as arrival_airport_key,
            departure_airport_name, arrival_airport_name, departure_city_name, flight_schedule_date as date_key,
            scheduled_departure, cancelled, is_delayed
        from outcomes""",
    "departures": """
        select departure_airport_code as airport_code, flight_schedule_date, count(*) as n
        from joined where departure_airport_code is not null group by all""",
    "arrivals": """
        select arrival_airport_code as airport_code, flight_schedule_date, count(*) as n
        from joined where arrival_airport_code is not null group by all""",
    "congestion": """
        select coalesce(d.airport_code, a.airport_code) as airport_code,
            coalesce(d.flight_schedule_date, a.flight_schedule_date) as flight_schedule_date,
            coalesce(d.n, 0) as nb_flight_departing, coalesce(a.n, 0) as nb_flight_arriving
        from departures d full outer join arrivals a
            on d.airport_code = a.airport_code and d.flight_schedule_date = a.flight_schedule_date""",
    "delay_rows": """
        select j.*, d.delay_duration, d.delay_code, case when d.delay_duration != '00' then 1 else 0 end as flag
        from joined j join delays d on j.leg_id = d.flight_leg_id""",
}

_ENTITIES = {
    "airport": ("departure_airport_code", "departure_airport_delayed_share"),
    "aircraft": ("aircraft_code", "aircraft_delayed_share"),
    "airline": ("airline_code", "airline_delayed_share"),
}
for _name, (_key, _share) in _ENTITIES.items():
    _CTES[f"daily_{_name}"] = f"""
        select {_key}, cast(flight_schedule_date as date) as flight_schedule_date,
            cast(sum(flag) as bigint) as delayed_count, count(*) as total_count
        from delay_rows where cancelled = false and {_key} is not null group by all"""
    _CTES[f"rolling_{_name}"] = f"""
        select {_key}, flight_schedule_date,
            cast(sum(delayed_count) over w as bigint) * 100.0::double
                / nullif(cast(sum(total_count) over w as bigint), 0) as {_share}
        from daily_{_name}
        window w as (partition by {_key} order by flight_schedule_date
            range between interval 7 days preceding and current row)"""

_CTES["ready"] = """
    select o.*, coalesce(dep.nb_flight_departing, 0) as nb_flight_departing_departure_airport,
        coalesce(dep.nb_flight_arriving, 0) as nb_flight_arriving_departure_airport,
        coalesce(arr.nb_flight_departing, 0) as nb_flight_departing_arrival_airport,
        coalesce(arr.nb_flight_arriving, 0) as nb_flight_arriving_arrival_airport,
        coalesce(sp.departure_airport_delayed_share, 0) as departure_airport_delayed_share,
        coalesce(sc.aircraft_delayed_share, 0) as aircraft_delayed_share,
        coalesce(sl.airline_delayed_share, 0) as airline_delayed_share
    from outcomes o
    left join congestion dep on o.departure_airport_code = dep.airport_code
        and o.flight_schedule_date = dep.flight_schedule_date
    left join congestion arr on o.arrival_airport_code = arr.airport_code
        and o.flight_schedule_date = arr.flight_schedule_date
    left join rolling_airport sp on o.departure_airport_code = sp.departure_airport_code
        and cast(o.flight_schedule_date as date) = sp.flight_schedule_date
    left join rolling_aircraft sc on o.aircraft_code = sc.aircraft_code
        and cast(o.flight_schedule_date as date) = sc.flight_schedule_date
    left join rolling_airline sl on o.airline_code = sl.airline_code
        and cast(o.flight_schedule_date as date) = sl.flight_schedule_date"""

_SHARES = [share for _, share in _ENTITIES.values()]
_ROUND_SHARES = ", ".join(f"round({s}, 6) as {s}" for s in _SHARES)
_NEARBY = ", ".join(
    f"nb_flight_{way}_{end}_airport" for end in ("departure", "arrival") for way in ("departing", "arriving")
)
_TIMES = "scheduled_departure, actual_departure, scheduled_arrival, actual_arrival, cancelled"
_LATE = "delay_code, delay_duration_minutes, departure_delay_minutes, arrival_delay_minutes"
_PARTS = "departure_weekday, departure_month, departure_hour, departure_monthday"
_GEO = ", ".join(f"{end}_{k}" for end in ("departure", "arrival") for k in ("city_code", "city_name", "country_code", "country_name"))
_AIRPORTS = "departure_airport_code, arrival_airport_code, departure_airport_name, arrival_airport_name"

# Model inputs, in model order. The class labels further down are fixed too.
_FEATURES = [
    "scheduled_flight_duration_minutes", "nb_flight_departing_departure_airport",
    "nb_flight_arriving_departure_airport", "nb_flight_departing_arrival_airport",
    "nb_flight_arriving_arrival_airport", "departure_airport_delayed_share", "aircraft_delayed_share",
    "airline_delayed_share", "departure_monthday", "departure_weekday", "departure_hour",
]
_CTES["frame"] = (
    "select leg_id, flight_id, "
    + ", ".join(f"cast({f} as double) as {f}" for f in _FEATURES)
    + ", cast(is_delayed as integer) as is_delayed from ready"
)
_CTES["means"] = "select " + ", ".join(f"avg({f}) as {f}" for f in _FEATURES) + " from frame"
_CTES["filled"] = (
    "select f.leg_id, f.flight_id, "
    + ", ".join(f"coalesce(f.{f}, m.{f}) as {f}" for f in _FEATURES)
    + ", f.is_delayed from frame f cross join means m"
)
_CTES["spread"] = (
    "select " + ", ".join(f"avg({f}) as {f}_m, stddev_pop({f}) as {f}_s" for f in _FEATURES) + " from filled"
)

# The line that the stored model of the scoring queries is.
_CTES["judged_legs"] = """
    select leg_id, flight_id, cast((scheduled_flight_duration_minutes::double - 300.0::double) / 120.0::double
        + 0.5::double * ((coalesce(departure_hour, 12)::double - 12.0::double) / 6.0::double)
        - (coalesce(departure_monthday, 15)::double - 15.0::double) / 8.0::double > 0 as integer) as predicted
    from outcomes f where not cancelled and not exists (select 1 from predictions p where p.leg_id = f.leg_id)"""

# ---- nested documents

_CTES["docs"] = """
    select *, strftime(l_shipdate, '%Y-%m-%d') as day,
        strftime(l_shipdate, '%Y-%m-%d') || '+' || l_linestatus || '+' || leg_key as doc_id,
        case when q = 1 then 0 else 1 + l_linenumber % 3 end as nb_legs
    from items"""
_CTES["doc_legs"] = """
    select d.*, cast(i.i as integer) as i, (d.q + i.i) % 5 as kind, d.doc_id || '_' || i.i as leg_name,
        (l_suppkey + i.i) % 25 as from_n, (l_suppkey + i.i + 1) % 25 as to_n
    from docs d, (select unnest(range(3)) as i) i where i.i < d.nb_legs"""
_CTES["doc_delays"] = """
    select doc_id, day, leg_name, 0 as j, case kind when 1 then '81' when 2 then 'A' when 3 then 'X' end as code,
        case when kind in (1, 2, 3) then 'PT' || q || 'M' else '00' end as duration
    from doc_legs
    union all select doc_id, day, leg_name, 1, 'Y', null from doc_legs where kind = 3"""
_CTES["usable_docs"] = "select * from docs where l_orderkey % 50 > 1"
_CTES["ingest_runs"] = """
    select n, doc_id, day, nb_legs, (select count(*) from doc_delays x where x.doc_id = d.doc_id) as nb_delays
    from usable_docs d cross join range(1, 3) r(n) where n = 2 or l_orderkey % 10 <> 5"""
_CTES["readable"] = "select * from docs where l_orderkey % 50 <> 0"

# ---- pipeline log

_CTES["payloads"] = """
    select event_id as id, ts as event_at, user_id, event_type as kind, cast(trunc(value) as integer) as amount,
        case when event_type = 'error' then 'ERROR' else 'INFO' end as level,
        case when event_type = 'view' then 'trusted' else 'ingestion' end as layer,
        case when user_id % 2 = 0 then 'flights_ingest' else 'flights_transform' end as dag_id,
        case event_type when 'view' then 'run_dbt' when 'purchase' then 'ingest_task' else 'tracking' end as task_id,
        case when user_id % 40 <> 39 then 'run-' || (user_id % 40) || '-' || strftime(ts, '%Y%m%d') end as run_id,
        case event_type when 'signup' then 'dag_started' when 'purchase' then 'ingestion_success'
            when 'error' then 'quality_check_failure' when 'view' then 'dbt_run_success' end as event_type,
        'event ' || event_id as message,
        case when event_type = 'error' and user_id % 3 = 0 then 'timeout' end as exception,
        case when user_id % 5 = 0 then strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
            when user_id % 5 = 1 then 'not a date' end as explicit_date,
        case when user_id % 5 = 0 then cast(ts as date)
            when user_id % 7 = 0 then date '2024-02-01' when user_id % 7 = 1 then date '2024-02-02'
            when user_id % 2 = 0 then cast(ts - interval 1 day as date) else cast(ts as date) end as business_date
    from events"""
_CTES["log"] = """
    select *, 'scheduler' as app,
        nullif('{' || concat_ws(',',
            case when kind = 'purchase' then '"vols_ingested":' || amount end,
            case when kind = 'view' then '"rows_inserted":' || amount end,
            case when kind = 'click' then '"records_processed":' || amount end,
            case when exception is not null then '"exception":"' || exception || '"' end,
            case when explicit_date is not null then '"explicit_business_date":"' || explicit_date
                || '","business_date":"' || explicit_date || '"' end)
            || '}', '{}') as extra,
        case when level = 'ERROR' or event_type like '%fail%' then 'FAILED'
            when event_type like '%success%' or event_type like '%reload%' then 'SUCCESS' else 'RUNNING' end as status
    from payloads"""
# Volumes by (kind, side of the DAG): a purchase claims ingested flights, a view transformed rows, a click
# whichever its DAG is about, through the generic count on the ingest side.
_CTES["claims"] = """
    select *, case when kind = 'purchase' then amount
            when kind = 'view' and dag_id = 'flights_ingest' then amount
            when kind = 'click' and dag_id = 'flights_ingest' then amount else 0 end as vols,
        case when kind = 'view' then amount
            when kind = 'click' and dag_id = 'flights_transform' then amount else 0 end as trans
    from log"""
_CTES["ranked"] = """
    select *, row_number() over (partition by run_id order by event_at, id) as rn from claims where run_id is not null"""
_CTES["run_ends"] = """
    select run_id, arg_max(event_at, rn) as finished_at
    from ranked where status in ('SUCCESS', 'FAILED') and rn > 1 group by run_id"""
_CTES["folded"] = """
    select run_id, arg_min(dag_id, rn) as dag_id, arg_min(business_date, rn) as date_metier,
        min(event_at) as started_at, arg_max(status, rn) as status,
        cast(coalesce(arg_max(vols, rn) filter (vols > 0), 0) as bigint) as vols_ingested,
        cast(coalesce(arg_max(trans, rn) filter (trans > 0), 0) as bigint) as transformation_rows,
        arg_max(coalesce(exception, message), rn) filter (status = 'FAILED') as error_message,
        arg_max(extra, rn) filter (extra is not null) as execution_context
    from ranked group by run_id"""
_CTES["runs"] = """
    select f.run_id, dag_id, date_metier, started_at, status, vols_ingested, transformation_rows, e.finished_at,
        cast(round((epoch_us(e.finished_at) - epoch_us(started_at)) / 1e6) as bigint) as duration_sec,
        error_message, execution_context
    from folded f left join run_ends e on f.run_id = e.run_id"""

# ---- metric samples

_CTES["samples"] = """
    select case when user_id % 2 = 0 then 'api' else 'database' end as job, 'i' || (user_id % 10) as instance,
        case event_type when 'click' then 'http_requests_total' when 'error' then 'up'
            when 'purchase' then 'node_filesystem_free_bytes' when 'signup' then 'node_filesystem_size_bytes'
            else 'process_resident_memory_bytes' end as metric,
        case user_id % 3 when 0 then '500' when 1 then '503' else '200' end as status, ts,
        case event_type when 'click' then cast(event_id % 500 as double)
            when 'error' then case when user_id % 4 = 0 then 0.0 else 1.0 end
            when 'signup' then value + 500.0 else value end as value
    from events"""
_CTES["newest"] = """
    select metric, job, instance, status, max(ts) as ts, arg_max(value, ts) as value from samples group by all"""
_WINDOW, _STEP = 6 * 3600, 2 * 3600


def _counter_windows(prefix: str, samples: str, metric: str, window: int, step: int) -> None:
    """Named subqueries, the last ``<prefix>windows``, with the increase of every series and evaluation time."""
    _CTES[f"{prefix}steps"] = f"""
        select job, instance, status, epoch_us(ts) / 1e6 as t, value, lag(value) over w as prev_value,
            lag(epoch_us(ts) / 1e6) over w as prev_at
        from {samples} where metric = '{metric}'
        window w as (partition by job, instance, status order by ts)"""
    _CTES[f"{prefix}evals"] = f"""
        select s.*, eval_at, case when prev_at > eval_at - {window} then
                case when value < prev_value then value else value - prev_value end end as grown
        from (select *, unnest(range(cast(ceil(t / {step}) * {step} as bigint),
                cast(ceil(t / {step}) * {step} as bigint) + {window}, {step})) as eval_at from {prefix}steps) s"""
    _CTES[f"{prefix}window_sums"] = f"""
        select job, instance, status, eval_at, count(*) as n, min(t) as first_at, max(t) as last_at,
            arg_min(value, t) as first_value, sum(grown) as raw, max(t) - min(t) as sampled,
            (max(t) - min(t)) / nullif(count(*) - 1, 0) as distance
        from {prefix}evals group by all having count(*) > 1"""
    _CTES[f"{prefix}windows"] = f"""
        select job, instance, status, eval_at, raw * (sampled + least(
                case when first_at - (eval_at - {window}) >= distance * 1.1 then distance / 2
                    else first_at - (eval_at - {window}) end,
                case when raw > 0 and first_value >= 0 then sampled * first_value / raw
                    else 1e18 end)
            + case when eval_at - last_at >= distance * 1.1 then distance / 2 else eval_at - last_at end)
            / sampled as increase
        from {prefix}window_sums where sampled > 0"""
    _CTES[f"{prefix}times"] = f"""
        select unnest(range(cast(ceil(min(epoch_us(ts)) / 1e6 / {step}) * {step} as bigint),
            cast(ceil(max(epoch_us(ts)) / 1e6 / {step}) * {step} as bigint) + {window}, {step})) as eval_at
        from {samples}"""


_counter_windows("", "samples", "http_requests_total", _WINDOW, _STEP)
_counter_windows("short_", "samples", "http_requests_total", 600, 300)
_CTES["service"] = """
    select case when user_id % 2 = 0 then 'postgres-analytics' else 'fastapi-service' end as job,
        'i' || (user_id % 3) as instance,
        case event_type when 'click' then 'node_cpu_seconds_total' when 'error' then 'up'
            when 'purchase' then 'node_filesystem_free_bytes' when 'signup' then 'node_filesystem_size_bytes'
            else 'process_resident_memory_bytes' end as metric,
        case when event_type = 'click' and user_id % 3 <> 0 then 'idle' else 'user' end as status,
        make_timestamp(epoch_us(ts) // 50) as ts,
        case event_type when 'click' then (event_id % 500) * 0.25::double
            when 'error' then case when user_id % 2 = 0 then 0.0 else 1.0 end
            when 'signup' then value + 500.0 when 'purchase' then value else value * 8000000.0::double end as value
    from events"""
_counter_windows("cpu_", "service", "node_cpu_seconds_total", 300, 60)
_CTES["busy"] = """
    select instance, eval_at, 100 - avg(increase / 300) * 100 as value from cpu_windows where status = 'idle'
    group by instance, eval_at"""
_CTES["stepped"] = """
    select job, instance, metric, status, ceil(epoch_us(ts) / 1e6 / 15) * 15 as t, arg_max(value, ts) as value
    from service group by all"""
_CTES["space"] = """
    select t, sum(value) filter (metric = 'node_filesystem_free_bytes')
        / nullif(sum(value) filter (metric = 'node_filesystem_size_bytes'), 0) * 100 as value
    from stepped group by t having value is not null"""


# Rule, severity, condition, seconds it must hold.
_RULES = (
    ("ServiceDown", "critical", "value = 0", 10),
    ("PostgresRAMUsageWarning", "warning", "value >= 67108864", 120),
    ("PostgresRAMUsageCritical", "critical", "value >= 134217728", 30),
    ("FastAPIRAMUsageWarning", "warning", "value >= 268435456", 120),
    ("FastAPIRAMUsageCritical", "critical", "value >= 402653184", 30),
    ("ServerCPUUsageCritical", "critical", "value >= 90", 300),
    ("ServerDiskSpaceLow", "warning", "value <= 10", 600),
)


def _memory(service: str, job: str) -> str:
    return "".join(
        f" union all select '{service}RAMUsage{tier}', 'all', t, max(value) from stepped"
        f" where metric = 'process_resident_memory_bytes' and job = '{job}' group by t"
        for tier in ("Warning", "Critical")
    )


_CTES["signals"] = (
    "select 'ServiceDown' as rule, job || '/' || instance as grp, t, max(value) as value from stepped"
    " where metric = 'up' group by job, instance, t"
    + _memory("Postgres", "postgres-analytics") + _memory("FastAPI", "fastapi-service")
    + " union all select 'ServerCPUUsageCritical', instance, eval_at, value from busy"
    " union all select 'ServerDiskSpaceLow', 'all', t, value from space"
)


def _by_rule(values) -> str:
    return "case rule " + " ".join(f"when '{r[0]}' then {values(r)}" for r in _RULES) + " end"


_CTES["judged"] = (
    f"select *, {_by_rule(lambda r: r[2])} as holds, {_by_rule(lambda r: repr(r[1]))} as severity,"
    f" {_by_rule(lambda r: r[3])} as hold_seconds from signals"
)
_CTES["marked"] = """
    select *, case when holds and lag(holds) over w then 0 else 1 end as opens
    from judged window w as (partition by rule, grp order by t)"""
_CTES["islands"] = """
    select *, sum(opens) over (partition by rule, grp order by t) as island from marked"""


def _rates(size_hours: int, slide_hours: int, closed: bool = True) -> str:
    having = """having make_timestamp((w + {}) * 1000000)
            <= (select max(event_at) from log) - interval 1 hour""".format(size_hours * 3600) if closed else ""
    size, slide = size_hours * 3600, slide_hours * 3600
    return f"""
        select make_timestamp(w * 1000000) as window_start, make_timestamp((w + {size}) * 1000000) as window_end,
            count(*) as events, count(*) filter (level = 'ERROR') as errors,
            round(count(*) filter (level = 'ERROR') * 100.0::double / count(*), 6) as error_rate
        from (select level, event_at, unnest(range(
                (epoch_us(event_at) // 1000000) // {slide} * {slide} - {size - slide},
                (epoch_us(event_at) // 1000000) // {slide} * {slide} + {slide}, {slide})) as w from log)
        group by w
        {having}"""


_METRIC = {
    "airport": ("departure_airport_name", 50),
    "city": ("departure_city_name", 50),
    "date": ("date_key", 10),
    "airline": ("airline_name", 10),
}
for _name, (_column, _floor) in _METRIC.items():
    _CTES[f"metrics_{_name}"] = f"""
        select label, cast(sum(d) as bigint) as total_retards, count(*) as total_vols,
            {_percent("sum(d)", "count(*)", 2)} as delayed_share
        from (select leg_id, max({_column}) as label, max(cast(is_delayed as integer)) as d from facts
            where {_column} is not null and is_delayed is not null
                and cast(date_key as date) >= date '2001-08-01' - interval 365 days
            group by leg_id)
        group by label having count(*) >= {_floor}"""

_RANGE = "timestamp '1996-01-01' and timestamp '1999-12-31 23:59:59'"
_LOG_RANGE = "timestamp '2024-01-03' and timestamp '2024-01-25 12:00:00'"
_DOC_RANGE = "day between '1996-01-01' and '1999-12-31'"


def _doc_place(side: str, n: str) -> str:
    return f"""
        'N' || {n} as {side}_airport_code, 'Airport ' || {n} as {side}_airport_name,
        case when {n} <> 7 then 'C' || ({n} % 20) end as {side}_city_code,
        case when {n} <> 7 then 'City ' || ({n} % 20) end as {side}_city_name,
        case when {n} <> 7 then 'R' || ({n} % 5) end as {side}_country_code,
        case when {n} <> 7 then 'Country ' || ({n} % 5) end as {side}_country_name"""


def _check(name: str, severity: str, failures: str, source: str) -> str:
    return (
        f"select '{name}' as check_name, '{severity}' as severity, cast({failures} as bigint) as failures,"
        f" case when {failures} > 0 then '{severity}' else 'pass' end as status from ({source})"
    )


def _unique(table: str, column: str, severity: str, source: str) -> str:
    repeated = f"select {column} from {source} where {column} is not null group by {column} having count(*) > 1"
    return _check(f"unique:{table}.{column}", severity, "count(*)", repeated)


def _not_null(table: str, column: str, source: str) -> str:
    return _check(f"not_null:{table}.{column}", "error", f"count(*) filter ({column} is null)", f"select * from {source}")


_CTES["airlines"] = (
    "select distinct airline_code as airline_key, airline_name from joined where airline_code is not null"
)
_CTES["airports"] = " union ".join(
    f"select {e}_airport_code as airport_key, {e}_airport_name as airport_name, {e}_city_code as city_code,"
    f" {e}_city_name as city_name, {e}_country_code as country_code, {e}_country_name as country_name"
    f" from joined where {e}_airport_code is not null"
    for e in ("departure", "arrival")
)
_CTES["dates"] = """
    select distinct flight_schedule_date as date_key, cast(flight_schedule_date as date) as flight_schedule_date,
        cast(extract(dow from cast(flight_schedule_date as date)) as integer) as day_of_week,
        cast(extract(month from cast(flight_schedule_date as date)) as integer) as month,
        cast(extract(year from cast(flight_schedule_date as date)) as integer) as year
    from joined where flight_schedule_date is not null"""

_STATEMENTS = {
    "ingest_documents": f"""
        select doc_id as id, cast(l_orderkey as integer) as flight_number, day as flight_schedule_date,
            case when q <> 2 then l_linestatus end as airline_code, cast(nb_legs as integer) as nb_legs
        from readable where {_DOC_RANGE}""",
    "normalize_flights": """
        select doc_id as id, cast(l_orderkey as integer) as flight_number, day as flight_schedule_date,
            case when q <> 2 then l_linestatus end as airline_code,
            case when q <> 2 then 'Airline ' || l_linestatus end as airline_name, 'MEDIUM' as haul,
            cast(null as varchar) as route, l_returnflag as flight_status_public,
            timestamp '2002-01-01 06:00:00' as fetched_at
        from docs""",
    "normalize_legs": f"""
        select {_uuid("leg_name")} as id, doc_id as flight_id, i as leg_order,
            {_doc_place("departure", "from_n")}, {_doc_place("arrival", "to_n")},
            case when kind = 3 then 'CANCELLED' else 'ARRIVED' end as published_status,
            date_trunc('second', l_shipdate + to_hours(2 * i)) as scheduled_departure,
            date_trunc('second', l_shipdate + to_hours(2 * i) + to_minutes(q)) as actual_departure,
            date_trunc('second', l_shipdate + to_hours(2 * i + 2)) as scheduled_arrival,
            cast(null as timestamp) as actual_arrival,
            'PT' || (1 + i) || 'H' || q || 'M' as scheduled_flight_duration, kind = 3 as cancelled,
            'A' || (l_partkey % 40) as aircraft_code, cast(null as varchar) as aircraft_name
        from doc_legs""",
    "normalize_delays": f"""
        select {_uuid("leg_name || '_' || j")} as id, {_uuid("leg_name")} as flight_leg_id, code as delay_code,
            cast(null as varchar) as delay_reason, duration as delay_duration
        from doc_delays""",
    "deterministic_ids": f"select leg_key as name, {_uuid('leg_key')} as uuid from items",
    "upsert_flights": """
        select id, flight_number,
            case when flight_status_public = 'P'
                then strftime(cast(flight_schedule_date as date) + 200, '%Y-%m-%d')
                else flight_schedule_date end as flight_schedule_date,
            airline_code, airline_name, haul, route,
            case when flight_status_public = 'O' then 'A' else flight_status_public end as flight_status_public,
            case when flight_status_public = 'O' then fetched_at + interval 1 day else fetched_at end as fetched_at
        from flights""",
    "upsert_legs": """
        select id, flight_id, case when cancelled then 'N3' else arrival_airport_code end as arrival_airport_code,
            case when cancelled then 'REROUTED' else published_status end as published_status, cancelled
        from legs""",
    "upsert_delays": """
        select leg_key || '_0' as id, leg_key as flight_leg_id,
            case when l_returnflag <> 'N' then 'C' || l_linenumber end as delay_code,
            case when l_returnflag = 'A' and q % 5 = 0 then 'PT1M' when l_returnflag = 'N' then '00' when q < 10 then null
                when q % 2 = 0 then 'PT' || q || 'M' else 'PT' || (q % 3) || 'H' || q || 'M' end as delay_duration
        from items""",
    "share_deltas": """
        select departure_airport_code, flight_schedule_date, delayed_count, total_count,
            cast(sum(delayed_count) over w as bigint) as delayed_sum, cast(sum(total_count) over w as bigint) as total_sum,
            round(cast(sum(delayed_count) over w as bigint) * 100.0::double
                / cast(sum(total_count) over w as bigint), 6) as departure_airport_delayed_share
        from daily_airport
        window w as (partition by departure_airport_code order by flight_schedule_date
            range between interval 7 days preceding and current row)""",
    "key_index": """
        select leg_key as key, strftime(o.o_orderdate, '%Y-%m') as period
        from items join orders o on items.l_orderkey = o.o_orderkey where q = 7""",
    "upsert_predictions": """
        select leg_id, flight_id, 0 as delay_predicted,
            case when delay_predicted = 1 then "timestamp" + interval 1 day else "timestamp" end as "timestamp"
        from predictions""",
    "ingestion_metrics": f"""
        select (select count(*) from readable where {_DOC_RANGE}) as flights,
            (select cast(coalesce(sum(nb_legs), 0) as bigint) from readable where {_DOC_RANGE}) as legs,
            (select count(*) from doc_delays where {_DOC_RANGE} and doc_id in (select doc_id from readable)) as delays,
            (select count(*) from docs where l_orderkey % 50 = 0) as pages_skipped, 'PARTIAL' as status""",
    "write_checkpoint": """
        select max(flight_schedule_date) || 'T23:59:59+00:00' as window_end,
            strftime(cast(max(flight_schedule_date) as date) + 1, '%Y-%m-%d') as next_start
        from flights""",
    "stage_flights": "select * exclude (route) from flights",
    "stage_legs": "select * from legs",
    "stage_delays": "select * exclude (delay_reason) from delays",
    "materialize_modes": """
        select mode, date_key, day_of_week, month, year
        from (select unnest(['view', 'table', 'incremental']) as mode) cross join dates""",
    "ingest_job": """
        select 'flight' as kind, doc_id as name,
            concat_ws('|', l_returnflag, day, nb_legs, (select count(*) from doc_delays x where x.doc_id = d.doc_id)) as value
        from usable_docs d
        union all select 'report', n || '.flights', cast(count(*) as varchar) from ingest_runs group by n
        union all select 'report', n || '.legs', cast(sum(nb_legs) as varchar) from ingest_runs group by n
        union all select 'report', n || '.delays', cast(sum(nb_delays) as varchar) from ingest_runs group by n
        union all select 'report', n || '.pages_skipped', cast((select count(*) from docs where l_orderkey % 50 = 0) as varchar)
        from range(1, 3) r(n)
        union all select 'report', n || '.flights_rejected', cast((select count(*) from docs where l_orderkey % 50 = 1) as varchar)
        from range(1, 3) r(n)
        union all select 'report', n || '.days_missing', cast((select max(cast(day as date)) - min(cast(day as date)) + 1 from docs)
            - count(distinct day) as varchar) from ingest_runs group by n
        union all select 'report', n || '.status', case when (select count(*) from docs where l_orderkey % 50 = 0) > 0
            or (select max(cast(day as date)) - min(cast(day as date)) + 1 from docs)
                > (select count(distinct day) from ingest_runs i where i.n = r.n) then 'PARTIAL' else 'SUCCESS' end
        from range(1, 3) r(n)
        union all select 'reject', '2002010' || n || 'T000000.' || kind, cast(count(*) as varchar)
        from (select case l_orderkey % 50 when 0 then 'page' else 'flight' end as kind from docs where l_orderkey % 50 < 2)
            cross join range(1, 3) r(n) group by n, kind""",
    "event_extra_json": "select id, extra from log",
    "rows_processed": "select event_id as id, cast(trunc(value) as bigint) + 2 as rows_processed from events",
    "delay_flag": "select id, delay_duration, case when delay_duration <> '00' then 1 else 0 end as flag from delays",
    "is_delayed": "select leg_id, is_delayed from outcomes",
    "iso_minutes": f"select id, delay_duration, {_iso('delay_duration')} as minutes from delays",
    "delay_minutes": f"""
        select id, {_minutes_between("actual_departure", "scheduled_departure")} as departure_delay_minutes,
            {_minutes_between("actual_arrival", "scheduled_arrival")} as arrival_delay_minutes
        from legs""",
    "time_features": f"select leg_id as id, {_PARTS} from outcomes",
    "business_date": "select id, business_date from payloads",
    "event_status": "select id, status from log",
    "event_volumes": """
        select id, cast(vols as bigint) as vols_ingested, cast(trans as bigint) as transformation_rows from claims""",
    "flight_label": """
        select leg_id, flight_number || ' - ' || airline_name || ' - ' || coalesce(departure_airport_name, 'None')
            || ' --> ' || arrival_airport_name as combined_field
        from facts""",
    "legs_with_flights": "select * from joined",
    "delay_events": """
        select leg_id, flight_id, flight_schedule_date, airline_code, delay_code, delay_duration, cancelled
        from delay_rows""",
    "delay_agg": "select * from delay_sums",
    "delays_per_leg": "select * from leg_delays",
    "airport_congestion": "select * from congestion",
    "share_increment": """
        select departure_airport_code, flight_schedule_date,
            round(departure_airport_delayed_share, 6) as departure_airport_delayed_share
        from rolling_airport where flight_schedule_date >= date '2001-06-24'""",
    "entity_days": """
        select 'airport' as kind, c.airport_code as code, c.flight_schedule_date, nb_flight_departing as departing,
            nb_flight_arriving as arriving, round(s.departure_airport_delayed_share, 6) as delayed_share
        from congestion c left join rolling_airport s on c.airport_code = s.departure_airport_code
            and cast(c.flight_schedule_date as date) = s.flight_schedule_date
        union all
        select 'aircraft', j.aircraft_code, j.flight_schedule_date, 0, 0, round(any_value(s.aircraft_delayed_share), 6)
        from joined j left join rolling_aircraft s on j.aircraft_code = s.aircraft_code
            and cast(j.flight_schedule_date as date) = s.flight_schedule_date
        group by all
        union all
        select 'airline', j.airline_code, j.flight_schedule_date, 0, 0, round(any_value(s.airline_delayed_share), 6)
        from joined j left join rolling_airline s on j.airline_code = s.airline_code
            and cast(j.flight_schedule_date as date) = s.flight_schedule_date
        group by all""",
    "legs_ready": f"""
        select leg_id, flight_id, flight_number, flight_schedule_date, airline_code, airline_name, {_AIRPORTS},
            {_TIMES}, {_LATE}, scheduled_flight_duration_minutes, aircraft_code, aircraft_name, {_GEO}, {_PARTS},
            {_NEARBY}, {_ROUND_SHARES}, is_delayed
        from ready""",
    "fct_flight_legs": f"""
        select leg_id, flight_id, flight_number, airline_code as airline_key, airline_name,
            departure_airport_code as departure_airport_key, arrival_airport_code as arrival_airport_key,
            departure_airport_name, arrival_airport_name, departure_city_name, flight_schedule_date as date_key,
            {_TIMES}, {_LATE}, scheduled_flight_duration_minutes, aircraft_code, aircraft_name, {_PARTS}, {_NEARBY},
            {_ROUND_SHARES}, is_delayed
        from ready""",
    "fact_increment": """
        select leg_id, scheduled_departure, date_key from facts
        where scheduled_departure >= (select max(scheduled_departure) - interval 3 days from facts
            where scheduled_departure < timestamp '2001-01-01')""",
    "dim_airlines": "select * from airlines",
    "dim_airports": "select * from airports",
    "dim_date": "select * from dates",
    "delay_kpis": f"""
        select coalesce({_percent("sum(total_retards)", "sum(total_vols)", 2)}, 0.0) as global_rate,
            cast(coalesce(sum(total_vols), 0) as bigint) as total_vols,
            cast(coalesce(sum(total_retards), 0) as bigint) as total_retards
        from metrics_airport""",
    "top_delayed": "select * from metrics_date order by delayed_share desc, label limit 20",
    "worst_label": f"""
        select label, delayed_share, (select {_percent("sum(total_retards)", "sum(total_vols)", 2)}
            from metrics_city) as global_rate
        from metrics_city order by delayed_share desc, label limit 1""",
    "confusion_matrix": """
        select case when delay_predicted = 1 and is_delayed then 'Vrais Positifs (VP)'
                when delay_predicted = 1 and not is_delayed then 'Faux Positifs (FP)'
                when delay_predicted = 0 and not is_delayed then 'Vrais Négatifs (VN)'
                when delay_predicted = 0 and is_delayed then 'Faux Négatifs (FN)' else 'Inconnu'
            end as prediction_type, count(*) as total
        from predictions p join facts f on p.leg_id = f.leg_id group by all""",
    "scored_days": "select distinct date_key as day from predictions p join facts f on p.leg_id = f.leg_id",
    "future_days": """
        select distinct date_key as day from predictions p join facts f on p.leg_id = f.leg_id
        where date_key >= '1999-07-01'""",
    "day_predictions": """
        select p.flight_id, flight_number, airline_name, departure_airport_name, arrival_airport_name, date_key,
            max(delay_predicted) as delay_predicted,
            flight_number || ' - ' || airline_name || ' - ' || coalesce(departure_airport_name, 'None') || ' --> '
                || arrival_airport_name as combined_field
        from predictions p join facts f on p.leg_id = f.leg_id where date_key = '1998-03-10' group by all""",
    "row_counts": """
        select 'fct_flight_legs' as table_name, count(*) as rows from facts union all select 'missing', 0""",
    "covered_traffic": f"""
        select count(distinct leg_id) as legs from facts where scheduled_departure between {_RANGE}""",
    "covered_range": f"""
        select count(distinct f.leg_id) as legs, true as sketch_is_near,
            {_percent("count(*) filter (delay_predicted = 1)", "count(delay_predicted)", 1)} as predicted_rate
        from facts f left join predictions p on f.leg_id = p.leg_id
        where cast(scheduled_departure as date) between date '1996-01-01' and date '1999-12-31'""",
    "predicted_delay_rate": f"""
        select {_percent("sum(case when delay_predicted = 1 then 1 else 0 end)", "count(*)", 1)} as predicted_rate
        from predictions p join facts f on p.leg_id = f.leg_id where scheduled_departure between {_RANGE}""",
    "unscored_legs": """
        select leg_id, flight_id, is_delayed from facts f where not cancelled
            and not exists (select 1 from predictions p where p.leg_id = f.leg_id)""",
    "feature_frame": "select * replace (" + ", ".join(f"round({s}, 6) as {s}" for s in _SHARES) + ") from frame",
    "impute_features": "select * replace (" + ", ".join(f"round({f}, 6) as {f}" for f in _FEATURES) + ") from filled",
    "scale_features": "select leg_id, flight_id, is_delayed, "
    + ", ".join(f"round(({f} - {f}_m) / case when {f}_s = 0 then 1 else {f}_s end, 4) + 0.0::double as {f}" for f in _FEATURES)
    + " from filled cross join spread",
    "fit_params": " union all ".join(
        f"select '{f}' as feature, round({f}_m, 4) as mean, round({f}_s, 4) as std from spread" for f in _FEATURES
    ),
    "stored_moments": " union all ".join(
        f"select '{f}' as feature, count(*) as rows, round(avg({f}), 4) as mean,"
        f" round(sqrt(var_pop({f}) * count({f}) / count(*)), 4) as std from ready"
        " where flight_schedule_date not between '1995-01-01' and '1995-12-31'" for f in _FEATURES
    ),
    "score_legs": """
        select leg_id, flight_id, predicted as delay_predicted, timestamp '2002-01-02' as "timestamp" from judged_legs""",
    "score_increment": """
        select leg_id, delay_predicted, "timestamp", (select count(*) from judged_legs) as first_run, 0 as second_run
        from (select leg_id, delay_predicted, "timestamp" from predictions
            union all select leg_id, predicted, timestamp '2002-01-02' from judged_legs)""",
    "enrich_events": """
        select id, event_at, app, level, layer, dag_id, task_id, run_id, event_type, message, business_date from log""",
    "fold_runs": "select * from runs",
    "task_outcome_events": """
        select 'task' || event_id as task_id, case when event_type = 'error' then 'ERROR' else 'INFO' end as level,
            'trusted' as layer, case when event_type = 'error' then 'task_failure' else 'task_success' end as event_type,
            case when event_type = 'error' then 'task failed for ' else 'task success for ' end
                || 'task' || event_id as message,
            cast(ts as date) as business_date,
            case when event_type = 'error' then 'exception=timeout'
                when event_type = 'purchase' and user_id % 3 = 0
                    then 'engine=batch;records_processed=1;vols_ingested=2'
                when event_type = 'purchase' then 'records_processed=1;vols_ingested=2'
                else concat_ws(';', case when user_id % 3 = 0
                        then 'engine=batch;records_processed=' || cast(trunc(value) as integer) end,
                    case when event_type = 'view' then 'row_count=' || cast(trunc(value) as integer) end)
            end as extra
        from events""",
    "recent_logs": """
        select id, event_at, level, layer, dag_id, task_id, event_type, message from log
        order by event_at desc, id desc limit 50""",
    "recent_logs_stored": """
        select id, event_at, level, layer, dag_id, task_id, event_type, message from log
        order by event_at desc, id desc limit 50""",
    "event_payloads": """
        select id, id % 50 = 0 and extra is not null as broken, case when whole then exception end as exception,
            case when whole then explicit_date end as explicit_date, cast(null as bigint) as no_number,
            cast(case when whole then vols else 0 end as bigint) as vols_ingested,
            cast(case when whole then trans else 0 end as bigint) as transformation_rows
        from (select *, id % 50 <> 0 as whole from claims)""",
    "recent_logs_short": """
        select id, event_at, level, layer, dag_id, task_id, event_type, message from log
        order by event_at desc, id desc limit 15""",
    "error_logs": "select id, event_at, layer, dag_id, task_id, message from log where level = 'ERROR'",
    "log_metrics": f"""
        select count(*) as total_events,
            {_percent("count(*) filter (level = 'ERROR')", "count(*)", 1)} as error_rate,
            cast(extract(day from max(event_at) - min(event_at)) + 1 as integer) as days_covered
        from log""",
    "ingestion_freshness": """
        select coalesce(strftime(max(date_metier), '%Y-%m-%d'), 'Aucun Run') as value from runs
        where status = 'SUCCESS'""",
    "successful_ingestions": f"""
        select count(*) as runs from log
        where event_type = 'ingestion_success' and event_at between {_LOG_RANGE}""",
    "mean_run_minutes": f"""
        select coalesce({_ratio("sum(duration_sec)", "(count(duration_sec) * 60)", 1)}, 0.0) as value from runs
        where status = 'SUCCESS' and started_at between {_LOG_RANGE}""",
    "throughput": f"""
        select coalesce({_ratio("sum(transformation_rows)", "cast(sum(duration_sec) as bigint)", 1)}, 0.0) as value
        from runs where status = 'SUCCESS' and duration_sec > 0 and started_at between {_LOG_RANGE}""",
    "run_audit": f"""
        select * exclude (error_message, execution_context) from runs where started_at between {_LOG_RANGE}
        order by started_at desc, run_id desc limit 50""",
    "dq_unique": _unique("dim_airlines", "airline_key", "warn", "airlines"),
    "dq_not_null": " union all ".join(
        _not_null("legs", c, "legs") for c in ("id", "departure_airport_code", "scheduled_departure")
    ),
    "source_freshness": " union all ".join(
        f"""select 'freshness:{name}.newest' as check_name, level as severity, cast(level <> 'none' as bigint) as failures,
            case when level <> 'none' then level else 'pass' end as status
        from (select case when age is null or age > 14 then 'error' when age > 7 then 'warn' else 'none' end as level
            from (select (epoch_us(timestamp '2001-08-12') - epoch_us(max({column}))) / 86400e6 as age from {source}))
        union all select 'row_count:{name}', 'error', cast(count(*) = 0 as bigint), case when count(*) = 0 then 'error' else 'pass' end
        from {source}"""
        for name, column, source in (
            ("flights", "cast(flight_schedule_date as timestamp)", "flights"), ("legs", "scheduled_departure", "legs"),
            ("events", "event_at - interval 8200 days", "log"),
            ("missing", "event_at", "(select * from log where false)"),
        )
    ),
    "dq_freshness": " union all ".join(
        f"""select 'freshness:{name}' as check_name, level as severity, cast(level <> 'none' as bigint) as failures,
            case when level <> 'none' then level else 'pass' end as status
        from (select case when age is null or age > 14 then 'error' when age > 7 then 'warn' else 'none' end as level
            from (select (epoch_us(timestamp '{as_of}') - epoch_us(max({column}))) / 86400e6 as age from {source}))"""
        for name, column, source, as_of in (
            ("flights.day", "cast(flight_schedule_date as timestamp)", "flights", "2001-08-12"),
            ("legs.scheduled_departure", "scheduled_departure", "legs", "2001-08-12"),
            ("events.event_at", "event_at", "log", "2024-02-12"),
        )
    ),
    "dq_row_count": _check("row_count:flights", "error", "greatest(1 - count(*), 0)", "select 1 from flights"),
    "dq_report": " union all ".join(
        [
            _unique("fct_flight_legs", "leg_id", "error", "facts"),
            _not_null("fct_flight_legs", "leg_id", "facts"),
            _not_null("fct_flight_legs", "flight_id", "facts"),
            _unique("dim_date", "date_key", "error", "dates"),
            _not_null("dim_date", "date_key", "dates"),
            _unique("dim_airlines", "airline_key", "warn", "airlines"),
            _not_null("dim_airlines", "airline_key", "airlines"),
            _unique("dim_airports", "airport_key", "warn", "airports"),
            _not_null("dim_airports", "airport_key", "airports"),
        ]
    ),
    "gauge_latest": """
        select job, instance, status, ts, value from newest where metric = 'process_resident_memory_bytes'""",
    "gauge_max": """
        select job, max(value) as value from newest where metric = 'process_resident_memory_bytes' group by job""",
    "gauge_diff": """
        select a.job, a.instance, a.status, round(a.value - b.value, 6) as value from newest a join newest b
            on a.job = b.job and a.instance = b.instance and a.status = b.status
        where a.metric = 'node_filesystem_size_bytes' and b.metric = 'node_filesystem_free_bytes'""",
    "gauge_ratio": """
        select round(f, 6) as numerator, round(s, 6) as denominator, round(f / s * 100, 6) as percent from (
            select sum(value) filter (metric = 'node_filesystem_free_bytes') as f,
                sum(value) filter (metric = 'node_filesystem_size_bytes') as s from newest)""",
    "counter_rate": f"""
        select job, status, make_timestamp(eval_at * 1000000) as eval_ts, round(sum(increase / {_WINDOW}), 6) as rate
        from windows group by all""",
    "counter_increase": """
        select make_timestamp(t.eval_at * 1000000) as eval_ts, round(coalesce(sum(increase), 0), 6) as increase
        from times t left join (select * from windows where regexp_full_match(status, '5..')) w on t.eval_at = w.eval_at
        group by t.eval_at""",
    "counter_rate_total": """
        select make_timestamp(t.eval_at * 1000000) as eval_ts, round(coalesce(sum(increase / 600), 0), 6) as rate
        from short_times t left join (select * from short_windows where status = '503') w on t.eval_at = w.eval_at
        group by t.eval_at""",
    "busy_percent": "select instance, make_timestamp(eval_at * 1000000) as eval_ts, round(value, 6) as value from busy",
    "free_space": """
        select 'ServerDiskSpaceLow' as rule, 'all' as grp, make_timestamp(cast(t * 1000000 as bigint)) as ts,
            round(value, 6) as value
        from space""",
    "down_targets": "select job, instance, status, ts from newest where metric = 'up' and value = 0",
    "sustained_alerts": """
        select rule, grp, any_value(severity) as severity, make_timestamp(cast(min(t) * 1e6 as bigint)) as started_at,
            make_timestamp(cast((min(t) + any_value(hold_seconds)) * 1e6 as bigint)) as fires_at,
            make_timestamp(cast(max(t) * 1e6 as bigint)) as ended_at
        from islands where holds group by rule, grp, island having max(t) - min(t) >= any_value(hold_seconds)""",
    "stream_ingest": """
        select doc_id as flight_id, day as flight_schedule_date, nb_legs as legs,
            (select count(*) from doc_delays x where x.doc_id = r.doc_id) as delays
        from readable r""",
    "stream_runs": "select * from runs",
    "stream_event_rates": _rates(6, 2),
    "corrected_event_rates": _rates(6, 2, closed=False),
    "run_episodes": """
        select run_id, min(event_at) as started_at, max(event_at) as last_at, arg_max(status, rn) as status, count(*) as events,
            arg_max(status, rn) not in ('SUCCESS', 'FAILED') as abandoned
        from (select *, sum(opens) over (partition by run_id order by rn) as episode
            from (select *, case when event_at <= lag(event_at) over (partition by run_id order by rn) + interval 6 hours
                then 0 else 1 end as opens from ranked))
        group by run_id, episode
        having max(event_at) + interval 6 hours <= (select max(event_at) from ranked) - interval 1 hour""",
    "stream_daily_counts": """
        select departure_airport_code, flight_schedule_date, delayed_count, total_count,
            round(cast(sum(delayed_count) over w as bigint) * 100.0::double
                / nullif(cast(sum(total_count) over w as bigint), 0), 6) as departure_airport_delayed_share
        from (select departure_airport_code, cast(flight_schedule_date as date)
                + case when cast(flight_id as bigint) % 100 = 7 then 3650 else 0 end as flight_schedule_date,
                cast(sum(flag) as bigint) as delayed_count, count(*) as total_count
            from delay_rows where cancelled = false and departure_airport_code is not null group by all)
        window w as (partition by departure_airport_code order by flight_schedule_date
            range between interval 7 days preceding and current row)""",
}
for _name, (_key, _share) in _ENTITIES.items():
    _STATEMENTS[f"daily_delay_counts_{_name}"] = f"select * from daily_{_name}"
    _STATEMENTS[f"share_{_name}"] = (
        f"select {_key}, flight_schedule_date, round({_share}, 6) as {_share} from rolling_{_name}"
    )
_STATEMENTS["refresh_job"] = _STATEMENTS["fct_flight_legs"]
for _name in _METRIC:
    _STATEMENTS[f"delay_metrics_{_name}"] = f"select * from metrics_{_name}"


# Raw tables after the change of ``refresh_job``: moved and shortened flights.
_CHANGED = {
    "flights": f"""
        select * replace (case when cast(id as bigint) % 200 = 3
            then strftime(cast(flight_schedule_date as date) + 45, '%Y-%m-%d') else flight_schedule_date end as flight_schedule_date)
        from ({_CTES["flights"]})""",
    "legs": f"""
        select * from ({_CTES["legs"]}) where cast(flight_id as bigint) % 200 <> 3 or leg_order < 2""",
    "delays": f"select d.* from ({_CTES['delays']}) d where flight_leg_id in (select id from legs)",
}


def _needed(sql: str, ctes: dict[str, str]) -> list[str]:
    """Named subqueries a text uses, each after those it depends on."""
    found: list[str] = []

    def visit(text: str) -> None:
        for name in ctes:
            if name not in found and re.search(rf"\b(?:from|join)\s+{name}\b", text):
                visit(ctes[name])
                if name not in found:
                    found.append(name)

    visit(sql)
    return found


def statements() -> dict[str, str]:
    """The complete SQL text of every checked query."""
    out = {}
    for name, sql in _STATEMENTS.items():
        ctes = _CTES | _CHANGED if name == "refresh_job" else _CTES
        parts = ",\n".join(f"{cte} as ({ctes[cte]})" for cte in _needed(sql, ctes))
        out[name] = f"with {parts}\n{sql}" if parts else sql
    return out
