"""The first round of boosting in plain SQL: bins, gradients, trees, and scores of held-out rows."""

from __future__ import annotations

from vitalflow import schemas as S
from vitalflow.models.boosted import CELLS, GAIN_DECIMALS, SPREAD, BoostedTrees

K = len(S.CLASSES)


def first_round(settings: BoostedTrees) -> tuple[str, str]:
    """(tables, query) on the table `split` (seq, features, label, is_test): class scores of the
    held-out rows after one round. Nodes are numbered 1 for the root, 2i and 2i + 1 below i."""
    ends = " union all ".join(
        f"select {f} as f, min({c}) as lo, max({c}) as hi from split where not is_test"
        for f, c in enumerate(S.FEATURES)
    )
    long = " union all ".join(
        f"select seq, is_test, {f} as f, {c} as v from split" for f, c in enumerate(S.FEATURES)
    )
    weight = "1.0::double" if not settings.balanced else "total::double / (classes * n)"
    allowed = " or ".join(
        f"(k = {k} and f in ({', '.join(map(str, settings.features_of(0, k)))}))" for k in range(K)
    )
    u = "('0x' || substr(md5(seq::varchar), 1, 8))::bigint"
    mixed = f"(xor({u}, {settings.salt(0)})::hugeint * {SPREAD}) % 4294967296"
    drawn = "true" if settings.row_share >= 1 else f"{mixed} < {int(settings.row_share * 2**32)}"
    tables = [
        f"ends as ({ends})",
        f"""cells as materialized (
          select seq, is_test, l.f, case when hi > lo then
            greatest(0, least({CELLS - 1}, floor((v - lo) / (hi - lo) * {CELLS})))::int else 0 end as cell
          from ({long}) l join ends using (f))""",
        """filled as (select f, cell, count(*) as n from cells where not is_test group by f, cell)""",
        """upto as materialized (
          select f, cell, sum(n) over (partition by f order by cell) as upto,
            sum(n) over (partition by f) as total from filled)""",
        f"""binned as materialized (
          select c.seq, c.is_test, c.f,
            least(coalesce(u.upto, 0) * {settings.bins} // t.total, {settings.bins - 1})::int as bin
          from cells c join (select f, max(total) as total from upto group by f) t on t.f = c.f
          asof left join upto u on u.f = c.f and c.cell > u.cell)""",
        "sizes as (select label, count(*) as n, sum(count(*)) over () as total,"
        " count(*) over () as classes from split where not is_test group by label)",
        f"weights as (select label, n, {weight} as w from sizes)",
        "starts as (select label as k, n * w / sum(n * w) over () as p from weights)",
        f"""slopes as materialized (
          select s.seq, k, w * ((s.label = k)::int - p) as g, w * p * (1 - p) as h
          from split s join weights using (label), starts where not s.is_test and {drawn})""",
        "at0 as materialized (select seq, k, is_test, 1::bigint as node from split, starts)",
    ]

    size = "h" if settings.newton else "n"
    level_wise = settings.leaves is None or (settings.depth is not None and 2**settings.depth <= settings.leaves)
    steps = settings.depth if level_wise else settings.leaves - 1
    # best first: of all leaves of a class the one of largest gain is split, else all of a level are
    leaf = "k" if not level_wise else "k, node"
    tables.append(
        f"""standing as (
          select 0 as step, * from at0
          union all
          select a.step + 1, a.seq, a.k, a.is_test,
            case when c.node is null then a.node else 2 * a.node + (b.bin > c.bin)::int end
          from standing a left join (
            select k, node, f, bin from (
              select k, node, f, bin, round(g * g / {size} + (tg - g) * (tg - g) / (t{size} - {size})
                - tg * tg / t{size}, {GAIN_DECIMALS}) as gain
              from (
                select k, node, f, bin, sum(g) over w as g, sum(h) over w as h, sum(n) over w as n,
                  sum(g) over t as tg, sum(h) over t as th, sum(n) over t as tn
                from (select k, node, f, bin, sum(g) as g, sum(h) as h, count(*) as n
                      from standing join slopes using (seq, k) join binned using (seq)
                      where {allowed} group by k, node, f, bin)
                window w as (partition by k, node, f order by bin), t as (partition by k, node, f))
              where n >= {settings.min_rows} and tn - n >= {settings.min_rows}
                and {size} > 1e-9 and t{size} - {size} > 1e-9)
            where gain > 0
            qualify row_number() over (partition by {leaf} order by gain desc, node, f, bin) = 1) c
            on c.k = a.k and c.node = a.node
          left join binned b on b.seq = a.seq and b.f = c.f
          where a.step < {steps})"""
    )
    scale = settings.rate * settings.step
    tables += [
        f"""leaves as (
          select k, node, case when sum(h) > 0 then {scale!r}::double * sum(g) / sum(h) else 0 end as value
          from standing join slopes using (seq, k) where step = {steps} group by k, node)""",
        f"""scored as (
          select a.seq, a.k, ln(p) + coalesce(value, 0) as score
          from standing a join starts using (k) left join leaves using (k, node)
          where a.is_test and step = {steps})""",
    ]
    shown = ", ".join(
        f"floor(cast(max(score) filter (k = {k}) as double)*10000 + 0.500001)/10000 as f{k}" for k in range(K)
    )
    query = f"select seq, label, {shown} from scored join split using (seq) group by seq, label"
    return ", ".join(tables), query
