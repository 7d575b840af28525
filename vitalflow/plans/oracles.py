"""The SQL counterpart of each registered query, for a plain SQL engine on the same tables."""

from __future__ import annotations

import re

from vitalflow.models import boosted
from vitalflow.plans.boosting_sql import first_round

SENSORS = ("X", "Y", "Z", "EDA", "HR", "TEMP")

RULE_A = "case when HR >= 110 or EDA >= 8 then 2 when HR >= 80 then 1 else 0 end"
RULE_B = "case when HR >= 100 then 2 when HR >= 75 or TEMP >= 36 then 1 else 0 end"
LABEL = "case {0} when 0 then 'No stress' when 1 then 'Moderate stress' when 2 then 'High stress' else '{1}' end"


def r4(expr: str, name: str) -> str:
    return f"floor(cast({expr} as double)*10000 + 0.500001)/10000 as {name}"


def half_up(names) -> str:
    """Arguments for `%f` that show six decimals with halves rounded up, which printf does not.

    A single-precision value times a million is exact in double precision.
    """
    return ", ".join(f"sign({c})*floor(abs({c}::double)*1000000 + 0.5)/1000000" for c in names)


def r4s(names, prefix: str = "") -> str:
    return ", ".join(r4(prefix + c, c) for c in names)


def label_of(expr: str, default: str = "Unknown") -> str:
    return LABEL.format(expr, default)


# Tables; each may use the ones before it.
TABLES = {
    "sensors": """
        select event_id as seq, 'N' || lpad(cast(user_id % 8 as varchar), 2, '0') as id,
          1704067200000000 + (epoch_us(ts) - 1704067200000000) // 720 as us,
          cast(event_id*37 % 257 - 128 as double) as X,
          cast(event_id*53 % 257 - 128 as double) as Y,
          case when event_id % 17 = 0 then null else cast(event_id*71 % 257 - 128 as double) end as Z,
          case when event_id % 13 = 0 then null else value/10 end as EDA,
          55 + value % 100 as HR,
          27 + cast(json_extract_string(props, '$.k') as double)/10 as TEMP,
          event_type
        from events""",
    "records": "select *, strftime(make_timestamp(us), '%Y-%m-%d %H:%M:%S.%g') as datetime from sensors",
    "labeled": """
        select *, case when seq % 11 = 0 then cast(seq % 3 as integer)
            when HR >= 110 or EDA >= 12 then 2 when HR >= 80 then 1 else 0 end as label
        from sensors""",
    "complete": """
        select * from labeled where X is not null and Y is not null and Z is not null
          and HR is not null and TEMP is not null and EDA is not null and label is not null""",
    "windows": "select id, us // 5000000 as w, "
    + ", ".join(f"cast(sum(coalesce({c}, 0.0))/count(*) as float) as {c}" for c in SENSORS)
    + " from sensors group by id, us // 5000000",
    "primary_scored": f"""
        select id, X, Y, Z, EDA, HR, TEMP, (w + 1)*5000 - 1 as datetime, w*5000 as windowStart,
          (w + 1)*5000 as windowEnd, {RULE_A} as stress_level from windows""",
    "batches": "select seq // 1000 as batch, id, "
    + ", ".join(f"avg({c}) as {c}" for c in SENSORS)
    + ", max(us) as last_us from sensors group by seq // 1000, id",
    "fallback_scored": f"select *, {RULE_A} as stress_level from batches",
    "points": """
        select 'nurse_stress' as measurement, id, 'primary' as source, datetime as time_ms,
          cast(X as double) as X, cast(Y as double) as Y, cast(Z as double) as Z,
          cast(EDA as double) as EDA, cast(HR as double) as HR, cast(TEMP as double) as TEMP, stress_level
        from primary_scored
        union all
        select 'nurse_stress', id, 'fallback', last_us // 1000000 * 1000, X, Y, Z, EDA, HR, TEMP, stress_level
        from fallback_scored""",
    "edge": "select max(time_ms) as now_ms from points",
    "predicted": f"""
        select *, case when EDA is not null then {RULE_A} end as pred_lgbm,
          case when Z is not null then {RULE_B} end as pred_gb from sensors""",
    "ranked": "select *, row_number() over (partition by id order by seq desc) as rn from predicted",
    "checks": """
        select event_type as pipeline, event_id as seq,
          1704067200000000 + (epoch_us(ts) - 1704067200000000) // 720 as check_us,
          value >= 5 as healthy,
          case when event_id % 9 = 0 then null when event_id % 50 = 0 then 0.0 else value*10 end as latency_s
        from events""",
    "one_monitor": "select * replace ('all' as pipeline) from checks",
    "replay": """
        select *, row_number() over (order by arrival, seq) // 500 as batch from (
          select *, us + case when seq % 10 = 0 then 20000000 else 0 end as arrival from sensors)""",
    "closed": """
        select * from primary_scored
        where windowEnd <= (select max(us) // 1000 from sensors) - 5000""",
}


def _states(source: str) -> str:
    return f"""
    flagged as (select *, (not healthy) or coalesce(latency_s > 300, false) as breach,
        healthy and coalesce(latency_s <= 300, false) as reset,
        healthy and coalesce(latency_s <> 0 and latency_s < 150, false) as stop from {source}),
    stretches as (select *, cast(sum(reset::int) over w as bigint) as run_id, sum(stop::int) over w as island
        from flagged window w as (partition by pipeline order by seq rows unbounded preceding)),
    runs as (select *, cast(sum(breach::int) over (partition by pipeline, run_id order by seq
        rows unbounded preceding) as bigint) as run from stretches),
    moded as (select *, max((run >= 3)::int) over (partition by pipeline, island order by seq
        rows unbounded preceding) = 1 as in_fallback from runs),
    states as (select *, coalesce(lag(in_fallback) over (partition by pipeline order by seq), false)
        as was_fallback, case when in_fallback then 0 else run end as violation_count from moded),
    timeline as (select pipeline, seq, case when in_fallback then 'TRIGGER' else 'RESUME' end as change,
        check_us as from_us, lead(check_us) over (partition by pipeline order by seq) as until_us
        from states where was_fallback <> in_fallback)"""


def sql(body: str, extra: str = "") -> str:
    """`body` behind the tables it (or another table it needs) names."""
    needed: set[str] = set()
    todo = [body + " " + extra]
    while todo:
        text = todo.pop()
        for name, definition in TABLES.items():
            if name not in needed and re.search(rf"(\bfrom|\bjoin|,)\s+{name}\b", text):
                needed.add(name)
                todo.append(definition)
    parts = [f"{n} as ({d})" for n, d in TABLES.items() if n in needed]
    if extra:
        parts.append(extra.strip())
    return (f"with {', '.join(parts)} " if parts else "") + body


def _grid(value: str, series: str, range_ms: int, step: int, fill: str = "", where: str = "true") -> str:
    names = [s.strip() for s in series.split(",")]
    match = " and ".join(f"a.{s} = s.{s}" for s in names)
    shown = f"coalesce(a.value, {fill})" if fill else "a.value"
    return sql(
        f"select {', '.join('s.' + s for s in names)}, g.bucket_ms, {{shown}} as value"
        f" from (select distinct {series} from found) s cross join"
        f" (select unnest(generate_series((now_ms - {range_ms}) // {step} * {step}, now_ms // {step} * {step},"
        f" {step})) as bucket_ms from edge) g"
        f" left join found a on {match} and a.bucket_ms = g.bucket_ms".replace("{shown}", shown),
        f"found as (select {series}, time_ms // {step} * {step} as bucket_ms, {value} as value"
        f" from points, (select now_ms from edge) e where time_ms >= now_ms - {range_ms} and time_ms <= now_ms"
        f" and {where} group by {series}, time_ms // {step} * {step})",
    )


def _rounded(query: str) -> str:
    """Round the `value` column of a bucket query."""
    return f"select * replace (floor(cast(value as double)*10000 + 0.500001)/10000 as value) from ({query})"


def _last(field: str) -> str:
    order = "time_ms*2 + case when source = 'fallback' then 1 else 0 end"
    return f"arg_max({field}, {order})"


CONFUSION = """
    m as (select count(*) as n, count(*) filter (label = p) as hits,
    """ + ", ".join(
    f"count(*) filter (label = {c} and p = {c}) as tp{c}, count(*) filter (p = {c}) as pr{c},"
    f" count(*) filter (label = {c}) as su{c}"
    for c in range(3)
) + " from judged)"


def _judged(prediction: str) -> str:
    return f"judged as (select label, {prediction} as p from complete)"


def _report(extra: str) -> str:
    def ratio(a: str, b: str) -> str:
        return f"(case when {b} > 0 then {a}*1.0/{b} else 0.0 end)"

    pr = [ratio(f"tp{c}", f"pr{c}") for c in range(3)]
    re_ = [ratio(f"tp{c}", f"su{c}") for c in range(3)]
    f1 = [ratio(f"2.0*tp{c}", f"(pr{c} + su{c})") for c in range(3)]
    rows = [
        f"select '{c}' as name, {r4(pr[c], 'precision')}, {r4(re_[c], 'recall')}, {r4(f1[c], 'f1')}, su{c} as support from m"
        for c in range(3)
    ]
    acc = ratio("hits", "n")
    rows.append(
        f"select 'accuracy', {r4(acc, 'precision')}, {r4(acc, 'recall')}, {r4(acc, 'f1')}, n from m"
    )
    present = "(" + " + ".join(f"case when pr{c} + su{c} > 0 then 1 else 0 end" for c in range(3)) + ")"
    macro = [ratio("(" + " + ".join(v) + ")", present) for v in (pr, re_, f1)]
    weighted = [
        ratio("(" + " + ".join(f"{v[c]}*su{c}" for c in range(3)) + ")", "n") for v in (pr, re_, f1)
    ]
    for name, v in (("macro avg", macro), ("weighted avg", weighted)):
        rows.append(
            f"select '{name}', {r4(v[0], 'precision')}, {r4(v[1], 'recall')}, {r4(v[2], 'f1')}, n from m"
        )
    return sql(" union all ".join(rows), extra + "," + CONFUSION)


FEATURES = ("X", "Y", "Z", "HR", "TEMP", "EDA")
SPLIT = """
    counts as (select label, count(*) as n from complete group by label),
    shares as (select label, n, tot - cast(ceil(tot*0.2) as bigint) as train, n*(tot - cast(ceil(tot*0.2) as bigint))/tot as exact
        from counts, (select cast(sum(n) as bigint) as tot from counts) t),
    quotas as (select label, n - cast(floor(exact) as bigint)
        - case when row_number() over (order by exact - floor(exact) desc, label)
            <= train - sum(cast(floor(exact) as bigint)) over () then 1 else 0 end as n_test from shares),
    hashed as (select *, ((((seq + 42) % 2147483648)*2654435761) % 4294967296
        + (((seq + 42) // 2147483648 % 2147483648)*2246822519) % 4294967296) % 4294967296 as h from complete),
    split as (select hashed.*, row_number() over (partition by hashed.label order by h, seq) <= n_test as is_test
        from hashed join quotas using (label))"""


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    closed_cols = f"id, {r4s(SENSORS)}, datetime, windowStart, windowEnd"
    float_cols = ", ".join(r4(f"cast({c} as float)", c) for c in SENSORS)

    q["flagship"] = sql(
        f"select id, windowStart, windowEnd, {r4s(SENSORS)}, stress_level, {label_of('stress_level')} as stress_label"
        " from primary_scored"
    )

    # sources
    q["read_stream_earliest"] = sql(f"select seq, id, us, {r4s(SENSORS)} from sensors")
    q["read_stream_latest_bounded"] = sql(
        f"select seq, id, us, {r4s(SENSORS)} from sensors where us >= 1704069000000000"
    )
    q["read_sensor_csv"] = sql(f"select id, datetime, {float_cols} from records")
    q["read_zipped_csv"] = q["read_sensor_csv"]
    point_cols = f"id, source, time_ms, {r4s(SENSORS)}, stress_level"
    q["scan_points"] = sql(
        f"select measurement, {point_cols} from points, edge where time_ms >= now_ms - 900000 and time_ms <= now_ms"
    )
    q["normalize_headers"] = sql(
        "select id as User_ID, us // 1000000 as Timestamp, X as Orientation_X, Y as Orientation_Y, Z as Orientation_Z,"
        f" {r4('HR', 'Heart_Rate')}, {r4('TEMP', 'Skin_Temp')}, {r4('EDA', 'EDA')}, label as Stress_Label from labeled"
    )

    # sinks
    q["to_line_protocol"] = sql(
        "select printf('flink_events,id=%s EDA=%f,HR=%f,TEMP=%f,stressLevel=%d %d', id,"
        f" {half_up(('EDA', 'HR', 'TEMP'))}, stress_level, datetime*1000000) as line from primary_scored"
    )
    q["write_points"] = sql(
        f"select measurement, {point_cols} from points where source = 'primary'"
        " and time_ms + 1 <= (select max(us) // 1000 from sensors) - 5000"
    )
    q["write_points_batch"] = sql(f"select measurement, {point_cols} from points where source = 'fallback'")
    q["upsert_points"] = sql(f"select measurement, {point_cols}, 1::bigint as batch_id from points"
                             ).replace("stress_level, 1::bigint", "stress_level + 1 as stress_level, 1::bigint")
    q["write_csv_per_id"] = sql(f"select id as person, id, datetime, {float_cols} from records")
    q["progress_commit"] = sql("select seq, id, us from sensors")

    # projections and filters
    q["project_sensor_columns"] = sql(f"select {r4s(SENSORS)}, id, datetime from records")
    q["filter_by_id"] = sql(f"select {r4s(SENSORS)}, id, datetime from records where id = 'N03'")
    q["drop_incomplete"] = sql(f"select seq, id, {r4s(SENSORS)}, label from complete")
    q["recent_range"] = sql(f"select {point_cols} from points, edge where time_ms > now_ms - 300000")
    q["filter_source"] = sql(f"select {point_cols} from points where source = 'primary' or source = 'fallback'")
    q["latest_points"] = sql(
        f"(select time_ms, id, {r4s(('HR', 'TEMP'))}, stress_level, source from points where source = 'primary'"
        " order by time_ms desc, id limit 3) union all "
        f"(select time_ms, id, {r4s(('HR', 'TEMP'))}, stress_level, source from points where source = 'fallback'"
        " order by time_ms desc, id limit 5)"
    )
    q["sample_points"] = sql(f"select {point_cols} from points order by time_ms, id, source limit 10")
    q["select_by_id_grouped"] = sql(f"select {point_cols} from points where id = 'N06' order by source, time_ms")
    bad = "case when event_type = 'error' then 'x' when event_type = 'signup' then 'hr' end"
    model = "case event_type when 'view' then 'gb' when 'click' then 'foo' else 'lgbm' end"
    q["validate_inputs"] = sql(
        f"select seq, case when event_type = 'error' then null else X end as x, Y as y, coalesce(Z, 0) as z,"
        f" {r4('coalesce(EDA, 0)', 'eda')}, case when event_type = 'signup' then null else floor(HR*10000 + 0.500001)/10000 end as hr,"
        f" {r4('TEMP', 'temp')}, {model} as model, coalesce('Missing or invalid parameter: ' || {bad},"
        f" case when {model} = 'foo' then 'Unknown model ''foo''. Choose ''lgbm'' or ''gb''.' end) as error from sensors"
    )

    # scalar functions
    q["parse_event_time"] = sql(
        "select seq, case event_type when 'error' then 1704067200123 when 'signup' then 1704067200123"
        " when 'view' then us // 1000000 * 1000 else us // 1000 end as event_ms from sensors"
    )
    q["parse_event_time_seconds"] = sql(
        "select seq, case event_type when 'error' then 1704067200123 when 'signup' then 1704067200123"
        " else us // 1000000 * 1000 end as event_ms from sensors"
    )
    q["assign_event_time"] = sql("select seq, us // 1000 as event_ms from sensors")
    q["format_event_time"] = sql("select seq, datetime from records")
    q["to_epoch_nanos"] = sql("select id, datetime*1000000 as time_ns from primary_scored")
    q["null_as_zero"] = sql(
        "select seq, " + ", ".join(r4(f"coalesce({c}, 0.0)", c) for c in SENSORS) + " from sensors"
    )
    q["empty_as_null"] = sql(f"select seq, {r4s(('Z', 'EDA'))} from sensors")
    q["stress_label"] = sql(
        f"select seq, {label_of('seq % 4')} as label, {label_of('seq % 4', '-')} as shown from sensors"
    )
    q["threshold_band"] = sql(
        "select seq, case when label >= 2 then 'red' when label >= 1 then 'yellow' else 'green' end as level_band,"
        " case when HR >= 80 then 'red' else 'green' end as sensor_band from labeled"
    )
    q["fallback_status"] = sql(
        "select user_id, case when n = 0 then 'Normal' when n between 1 and 999999 then 'Fallback Active' end as status"
        " from (select user_id, count(*) filter (event_type = 'error') as n from events group by user_id)"
    )
    q["parse_prediction"] = sql(
        "select seq, case event_type when 'error' then null else label end as prediction from labeled"
    )
    q["feature_text"] = sql(
        "select id, windowEnd, printf('x=%f&y=%f&z=%f&eda=%f&hr=%f&temp=%f',"
        f" {half_up(SENSORS)}) as request from primary_scored"
    )
    q["prediction_response"] = sql(
        f"select id, windowEnd, cast(stress_level as varchar) as stress_level_prediction, {label_of('stress_level')}"
        f" as stress_label, 'lgbm' as model, " + ", ".join(r4(c, f"in_{c.lower()}") for c in SENSORS)
        + " from primary_scored"
    )
    q["label_delta"] = sql("select seq, abs(pred_lgbm - pred_gb) as delta, pred_lgbm = pred_gb as same from predicted")
    q["assemble_features"] = sql(
        "select seq, " + ", ".join(r4(c, f"f{i}") for i, c in enumerate(FEATURES)) + " from complete"
    )

    # aggregations
    q["window_avg_null_zero"] = sql(f"select {closed_cols} from primary_scored")
    q["batch_avg_skip_null"] = sql(
        f"select batch, id, {r4s(SENSORS)}, strftime(make_timestamp(last_us), '%Y-%m-%d %H:%M:%S.%g') as datetime from batches"
    )
    counts = ", ".join(f"count({c}) as count_{c}" for c in (*SENSORS, "stress_level"))
    q["count_points"] = sql(f"select {counts} from points")
    q["count_by_source"] = sql("select source, count(stress_level) as n from points group by source")
    q["fallback_activity"] = sql(
        "select n, case when n = 0 then 'Normal' when n between 1 and 999999 then 'Fallback Active' end as status,"
        " n > 0 as alert from (select count(stress_level) as n from points, edge where source = 'fallback'"
        " and time_ms > now_ms - 300000)"
    )
    q["value_counts"] = sql("select id, count(*) as n from sensors group by id")
    q["describe_series"] = " union all ".join(
        sql(
            f"select '{c}' as key, '{'tag' if c in ('id', 'source') else 'field'}' as kind,"
            f" '{'string' if c in ('id', 'source') else 'int' if c == 'stress_level' else 'double'}' as type,"
            f" count({c}) as n_values, "
            + (f"count(distinct {c})" if c in ("id", "source") else "cast(null as bigint)")
            + " as n_distinct from points"
        ).replace("with ", "select * from (with ", 1) + ")"
        for c in ("id", "source", *SENSORS, "stress_level")
    )
    columns = (*FEATURES, "label")
    q["correlation_matrix"] = sql(
        " union all ".join(
            f"select '{a}' as a, '{b}' as b, {r4(f'corr({a}, {b})', 'corr')} from complete"
            for a in columns
            for b in columns
        )
    )
    q["accuracy"] = sql(f"select {r4('avg(case when label = p then 1.0 else 0.0 end)', 'accuracy')} from judged", _judged(RULE_A))
    q["classification_report"] = _report(_judged(RULE_A))
    q["evaluate_model"] = _report(
        SPLIT + f", judged as (select label, {RULE_A} as p from split where is_test)"
    )
    q["csv_to_report"] = q["evaluate_model"]
    q["confusion_matrix"] = sql(
        "select c.label, " + ", ".join(f"count(*) filter (p = {c}) as predicted_{c}" for c in range(3))
        + " from (select unnest([0, 1, 2]) as label) c left join judged j on j.label = c.label group by c.label",
        _judged(RULE_A),
    )
    for name, settings in (
        ("train_gb", boosted.GRADIENT_BOOSTING),
        ("train_hist_gb", boosted.HISTOGRAM_BOOSTING),
        ("train_lgbm", boosted.LEAF_BOOSTING),
    ):
        tables, scores = first_round(settings)
        q[name] = sql(scores, f"{SPLIT}, {tables}").replace("with ", "with recursive ", 1)
    q["save_model"] = sql("select seq, label, true as agree from split where is_test", SPLIT)
    steps = ", ".join(str(n) for n in range(50, boosted.LEAF_BOOSTING.trees + 1, 50))
    q["train_lgbm_logloss"] = sql(
        "select unnest([" + steps + "]) as trees, n_rows, "
        + r4("ln(n_rows) - s / n_rows", "shares_loss") + ", true as lower"
        " from (select cast(sum(n) as bigint) as n_rows, sum(n * ln(n)) as s"
        " from (select count(*) as n from split where is_test group by label))",
        SPLIT,
    )
    w = ("1 + abs(X)", "1 + abs(Y)", "1 + HR")
    total = " + ".join(f"({x})" for x in w)
    q["multi_logloss"] = sql(
        f"select {r4('avg(-ln(greatest(case label when 0 then p0 when 1 then p1 when 2 then p2 end, 1e-15)))', 'logloss')}"
        f" from (select label, " + ", ".join(f"({x})/({total}) as p{i}" for i, x in enumerate(w)) + " from complete)"
    )
    q["class_weights"] = sql(
        f"select seq, label, {r4('tot/(k*n)', 'weight')} from complete join"
        " (select label, n, sum(n) over () as tot, count(*) over () as k from"
        " (select label, count(*) as n from complete group by label)) using (label)"
    )
    q["source_overlap"] = sql(
        "select *, case when n_primary > 0 and n_fallback > 0 then 'both' when n_primary > 0 then 'primary'"
        " else 'fallback' end as coverage from (select id, time_ms // 60000 * 60000 as bucket_ms,"
        " count(*) filter (source = 'primary') as n_primary, count(*) filter (source = 'fallback') as n_fallback"
        " from points group by all)"
    )
    q["fleet_summary"] = sql(
        "select count(*) as active, count(*) filter (pred_lgbm = 2) as high_pred_lgbm,"
        " count(*) filter (pred_gb = 2) as high_pred_gb,"
        " count(*) filter (pred_lgbm is not distinct from pred_gb) as agree from ranked where rn = 1"
    )

    # time buckets
    five, quarter, minute = 300_000, 900_000, 60_000
    for name, field in (("stress", "stress_level"), ("hr", "HR"), ("temp", "TEMP"), ("eda", "EDA")):
        query = _grid(_last(field), "id", five, minute, where="source = 'primary'")
        q[f"last_{name}_by_bucket"] = query if name == "stress" else _rounded(query)
    q["mean_stress_by_source_1m"] = _rounded(_grid("avg(stress_level)", "source", quarter, minute))
    for name, field in (("stress", "stress_level"), ("hr", "HR"), ("temp", "TEMP")):
        q[f"mean_{name}_by_id_1m"] = _rounded(_grid(f"avg({field})", "id", quarter, minute))
    q["count_by_source_1m"] = _grid("count(stress_level)", "source", quarter, minute, "0")
    q["count_by_source_1m_unfilled"] = sql(
        "select source, time_ms // 60000 * 60000 as bucket_ms, count(stress_level) as value from points, edge"
        " where time_ms >= now_ms - 900000 group by all"
    )
    q["mean_by_id_source_1m"] = _rounded(
        sql(
            "select id, source, time_ms // 60000 * 60000 as bucket_ms, avg(stress_level) as value from points"
            " where source in ('primary', 'fallback') group by all"
        )
    )
    q["fill_buckets"] = _grid("count(HR)", "id, source", 3_600_000, 10_000, "0")
    q["auto_interval"] = _rounded(_grid("avg(HR)", "id", quarter, 180_000))
    q["legend_stats"] = (
        "select id, floor(arg_max(value, bucket_ms)*10000 + 0.500001)/10000 as last_not_null,"
        " floor(avg(value)*10000 + 0.500001)/10000 as mean"
        f" from ({_grid('avg(stress_level)', 'id', quarter, minute)}) group by id"
    )

    # windows
    shown = f"seq, id, {r4s(('HR', 'TEMP', 'EDA'))}, pred_lgbm, pred_gb"
    q["latest_per_id"] = sql(f"select {shown} from ranked where rn = 1")
    q["rolling_history"] = sql(f"select {shown} from ranked where rn <= 60")
    q["delta_vs_history_mean"] = sql(
        "select id, "
        + ", ".join(
            r4(f"arg_max_null({c}, seq)", c) + ", " + r4(f"arg_max_null({c}, seq) - avg({c})", f"delta_{c}")
            for c in ("HR", "TEMP", "EDA", "Z")
        )
        + " from ranked where rn <= 60 and HR is not null group by id"
    )
    differ = "rn <= 60 and pred_lgbm <> pred_gb"
    first_ten = f"select {shown} from ranked where {differ} order by id, seq desc limit 10"
    q["disagreement_log"] = sql(first_ten)
    q["disagreement_log_carry"] = sql(
        f"({first_ten}) union all select {shown} from ranked where rn = 1 and pred_lgbm <> pred_gb and id >"
        f" (select case when count(*) >= 10 then max(id) end from (select id from ranked where {differ}"
        " order by id, seq desc limit 10))"
    )
    clock = "1704067200000000 + pos*3000"
    placed = "(select *, row_number() over (partition by id order by seq) - 1 as pos from sensors)"
    stamp = f"strftime(make_timestamp({clock}), '%Y-%m-%d %H:%M:%S.%g') as datetime"
    q["synthetic_clock"] = sql(f"select seq, id, {clock} as clock_us, {stamp} from {placed}")
    q["replay_batches"] = sql(
        f"select seq, id, pos // 330 as batch, {clock} as clock_us, {stamp} from {placed} where pos // 330 <="
        " (select min(n // 330) from (select count(*) as n from sensors group by id))"
    )
    q["stratified_split"] = sql("select seq, label, is_test from split", SPLIT)
    q["violation_runs"] = sql("select pipeline, seq, breach, reset, run_id, run from runs", _states("checks"))

    # streaming
    q["bounded_watermark"] = sql(f"select {closed_cols} from closed")
    since = "us - 1704067200000000"
    parted = (
        "parted as (select s.*, floor(place * 6 / (max(place) over () + 1)) as part from"
        " (select *, {place} as place from sensors) s)"
    )
    q["idle_partition"] = sql(
        "select id, count(distinct us // 5000000) as n_closed, max(us // 5000000 * 5000 + 5000) as last_end"
        " from heard where us // 5000000 * 5000 + 5000 <= (select max(us) // 1000 from heard) - 5000 group by id",
        parted.format(place=since) + ", heard as (select * from parted where id <> 'N03' or part = 0)",
    )
    q["tumbling_avg_stream"] = sql(f"select {closed_cols} from closed")
    q["window_metadata"] = sql("select id, datetime, windowStart, windowEnd from closed")
    q["score_stream"] = sql(f"select id, windowEnd, {r4s(SENSORS)}, stress_level from closed")
    q["stress_alert"] = sql("select id, windowEnd, stress_level from closed where stress_level = 2")
    # the watermark of two micro-batches ago decides which windows are closed
    kept = (
        "newest as (select part, max(us) as newest from parted group by part),"
        " marks as (select part, max(newest) over (order by part rows between unbounded preceding"
        " and 2 preceding) as seen from newest),"
        " kept as (select p.* from parted p join marks using (part) where seen is null"
        " or us // 5000000 * 5000 + 5000 > seen // 1000 - 5000)"
    )
    late = f"({since} + case when seq % 10 = 0 then 20000000 else 0 end)"
    q["late_drop"] = sql(
        "select id, us // 5000000 * 5000 as windowStart, "
        + ", ".join(r4(f"cast(sum(coalesce({c}, 0.0)) / count(*) as float)", c) for c in SENSORS)
        + " from kept where us // 5000000 * 5000 + 5000 <= (select max(us) // 1000 from sensors) - 5000"
        " group by id, us // 5000000",
        parted.format(place=late) + ", " + kept,
    )
    q["count_batches"] = sql("select seq, id, seq // 1000 as batch from sensors")
    q["count_or_time_batches"] = sql(
        "select p.seq, p.id, p.arrival_ms, h.pos as batch_start from placed p asof join heads h on p.pos >= h.pos",
        "placed as materialized (select seq, id, us // 1000 as arrival_ms,"
        " row_number() over (order by us // 1000, seq) - 1 as pos from sensors),"
        " heads as (select pos, arrival_ms from placed where pos = 0 union all"
        " select min(p.pos), arg_min(p.arrival_ms, p.pos) from heads h join placed p"
        " on p.pos > h.pos and (p.pos = h.pos + 1000 or p.arrival_ms > h.arrival_ms + 30000) group by h.pos)",
    ).replace("with ", "with recursive ", 1)
    ahead = "(us - 1704067200000000) // 1000"
    q["count_or_time_stream"] = sql(
        "select partition, seq, batch, closed_by from numbered"
        " where closed_by = 'count' or not is_last or (select max(arrival_ms) from placed) - 1000 > first_ms + 30000",
        "placed as materialized (select *, row_number() over (partition by partition order by arrival_ms, seq) - 1 as pos"
        f" from (select seq, seq % 2 as partition, case when {ahead} < 1200000 then {ahead} // 200"
        f" else {ahead} - 1194000 end + 1704067200000 as arrival_ms from sensors)),"
        " heads as (select partition, pos, arrival_ms from placed where pos = 0 union all"
        " select h.partition, min(p.pos), arg_min(p.arrival_ms, p.pos) from heads h join placed p"
        " on p.partition = h.partition and p.pos > h.pos and (p.pos = h.pos + 1000 or p.arrival_ms > h.arrival_ms + 30000)"
        " group by h.partition, h.pos),"
        " ordered as (select partition, pos, arrival_ms as first_ms,"
        " row_number() over (partition by partition order by pos) - 1 as batch,"
        " lead(pos) over (partition by partition order by pos) as next_pos from heads),"
        " sizes as (select partition, count(*) as n from placed group by partition),"
        " whole as (select o.*, next_pos is null as is_last, case when coalesce(next_pos, n) - pos = 1000"
        " then 'count' else 'time' end as closed_by from ordered o join sizes using (partition)),"
        " numbered as (select p.partition, p.seq, w.batch, w.closed_by, w.is_last, w.first_ms"
        " from placed p asof join whole w on p.partition = w.partition and p.pos >= w.pos)",
    ).replace("with ", "with recursive ", 1)
    last_sixty = "partition by id order by us, seq rows between 59 preceding and current row"
    q["history_stream"] = sql(
        "select seq, id, "
        + ", ".join(
            r4(f"avg(case when HR is not null then {c} end) over w", f"mean_{c}") + ", "
            + r4(f"{c} - avg(case when HR is not null then {c} end) over w", f"delta_{c}")
            for c in ("HR", "TEMP", "EDA", "Z")
        )
        + f", count(HR) over w as n_history from sensors window w as ({last_sixty})"
    )
    q["fallback_stream"] = q["write_points_batch"]
    full = " and ".join(f"{c} is not null" for c in SENSORS)
    q["score_remote"] = sql(
        "select seq, case when HR >= 154.9 then 1 when HR >= 110 or EDA >= 8 then 2 else 0 end as stress_level from complete"
    )
    q["score_with_default"] = sql(
        f"select seq, coalesce(p, 1) as stress_level, p is null as was_default from"
        f" (select seq, case when {full} then {RULE_A} end as p from sensors)"
    )
    q["stream_restart"] = q["tumbling_avg_stream"]

    # control
    q["processing_lag"] = sql(
        f"select max(time_ms) as last_ms, {r4('(any_value(now_ms) - max(time_ms))/1000.0', 'lag_s')} from points, edge"
        " where source = 'fallback' and time_ms > now_ms - 600000"
    )
    q["lag_by_source"] = sql(
        f"select source, max(time_ms) as last_ms, {r4('(any_value(now_ms) - max(time_ms))/1000.0', 'lag_s')}"
        " from points, edge where time_ms > now_ms - 600000 group by source"
    )
    q["fallback_state"] = sql(
        "select pipeline, seq, was_fallback, in_fallback, violation_count from states", _states("checks")
    )
    q["fallback_state_stream"] = q["fallback_state"]
    q["mode_state"] = sql(
        "select pipeline, arg_max(in_fallback, seq) as in_fallback, arg_max(violation_count, seq) as violation_count"
        " from states group by pipeline",
        _states("checks"),
    )
    q["mode_timeline"] = sql(
        "select pipeline, seq, change, from_us, until_us,"
        f" {r4('(until_us - from_us)/1000000.0', 'duration_s')} from timeline",
        _states("checks"),
    )
    q["triggers_by_period"] = sql(
        "select pipeline, from_us // 1000 // 600000 * 600000 as period_ms, count(*) filter (change = 'TRIGGER') as triggers,"
        " count(*) filter (change = 'RESUME') as resumes from timeline group by 1, 2",
        _states("checks"),
    )
    q["dual_path_points"] = sql(
        f"select {point_cols} from points where source = 'primary' union all"
        f" select {point_cols} from (select p.*, t.change from points p asof join marks t on p.time_ms >= t.at_ms"
        " where p.source = 'fallback') where change = 'TRIGGER'",
        _states("one_monitor")
        + ", marks as (select from_us // 1000 as at_ms, arg_max(change, from_us) as change from timeline group by 1)",
    )
    q["dual_path_stream"] = sql(
        f"select {point_cols} from (select p.*, t.in_fallback, t.until_us from points p asof join between_checks t"
        " on p.time_ms >= t.from_us // 1000 where p.source = 'fallback')"
        " where in_fallback and until_us is not null",
        _states("one_monitor")
        + ", between_checks as (select check_us as from_us, in_fallback,"
        " lead(check_us) over (order by seq) as until_us from states"
        " qualify coalesce(lead(check_us) over (order by seq) // 1000 > check_us // 1000, true))",
    )
    offsets = (
        "(select event_type as reader, user_id % 2 as partition, max(event_id) as latest_offset,"
        " max(case when value >= 5 then event_id end) as committed_offset from events group by 1, 2)"
    )
    q["consumer_lag"] = (
        f"select *, latest_offset - coalesce(committed_offset, 0) as lag from {offsets}"
    )
    q["consumer_lag_totals"] = (
        "select reader, cast(sum(latest_offset - coalesce(committed_offset, 0)) as bigint) as total_lag,"
        f" max(latest_offset - coalesce(committed_offset, 0)) as max_lag from {offsets} group by reader"
    )

    # models
    q["score_batch"] = sql(f"select seq, {RULE_A} as lgbm, {RULE_B} as gb from sensors")
    q["score_requests"] = sql(
        f"select seq, model, error, cast(level as varchar) as stress_level_prediction, case when error is null then {label_of('level')} end as stress_label"
        f" from (select *, case when error is null then case model when 'gb' then {RULE_B} else case when HR >= 110 or coalesce(EDA, 0) >= 8 then 2 when HR >= 80 then 1 else 0 end end end as level from"
        f" (select *, {model} as model, coalesce('Missing or invalid parameter: ' || {bad},"
        f" case when {model} = 'foo' then 'Unknown model ''foo''. Choose ''lgbm'' or ''gb''.' end) as error from sensors))"
    )
    q["compare_models"] = sql(
        "select seq, pred_lgbm, pred_gb, pred_lgbm is not distinct from pred_gb as agree,"
        " abs(pred_lgbm - pred_gb) as delta from predicted"
    )
    return q
