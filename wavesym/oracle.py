"""The same queries as SQL for DuckDB, over views named like the tables.

Written from the definitions (windows, joins, pivots), not from the Spark plans: words are windows,
the merge of word lengths is the literal many-to-many join.
"""

from __future__ import annotations

from wavesym.catalog import COHORT

LETTERS = "ABCDE"

EVENTS = """pts as (
  select cast(user_id % 2 as varchar) as label, cast(user_id as varchar) as id, event_type as sid,
         row_number() over (partition by user_id, event_type order by ts, event_id) - 1 as pos,
         value as x
  from events)"""

LINEITEM = """pts as (
  select cast(l_suppkey % 2 as varchar) as label, cast(l_suppkey as varchar) as id,
         l_returnflag as sid,
         row_number() over (partition by l_suppkey, l_returnflag
           order by l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice) - 1 as pos,
         l_extendedprice as x
  from lineitem)"""

EMBEDDINGS = """pts as (
  select cast(label % 2 as varchar) as label, cast(vec_id as varchar) as id, 'w0' as sid,
         cast(unnest(range(len(embedding))) as bigint) as pos,
         cast(unnest(embedding) as double) as x
  from embeddings)"""

SMOOTH = """ma as (
  select *, avg(x) over (partition by id order by sid, pos
                         rows between 16 preceding and current row) as ma
  from pts),
q as materialized (
  select id, quantile_disc(ma, [0.2, 0.4, 0.6, 0.8]) as q from ma group by id)"""

LETTERED = """lettered as (
  select p.*, case when x < q.q[1] then 'A' when x < q.q[2] then 'B'
                   when x < q.q[3] then 'C' when x < q.q[4] then 'D' else 'E' end as s
  from pts p join q using (id))"""


def words(a: int) -> str:
    return f"""w{a} as (
  select label, id, sid, pos,
         string_agg(s, '') over (partition by id, sid order by pos
           rows between current row and {a - 2} following) as seq,
         lead(s, {a - 1}) over (partition by id, sid order by pos) as nx
  from lettered)"""


def transitions(a: int) -> str:
    share = ", ".join(f"count(*) filter (where nx = '{c}') / count(*) as p{c}" for c in LETTERS)
    return f"""t{a} as (
  select label, id, sid, {a} as word_length, seq, {share}
  from w{a} where length(seq) = {a - 1} group by label, id, sid, seq)"""


def all_transitions(lengths=(6, 7)) -> str:
    parts = [f"{words(a)},\n{transitions(a)}" for a in lengths]
    union = " union all ".join(f"select * from t{a}" for a in lengths)
    return ",\n".join([*parts, f"t as ({union})"])


TEMPLATES = f"""tpl as (
  select word_length, seq, {", ".join(f"avg(p{c}) as r{c}" for c in LETTERS)}
  from t where {COHORT} group by word_length, seq)"""

_SQUARES = " + ".join(f"(p{c} - r{c}) * (p{c} - r{c})" for c in LETTERS)

DISTANCES = f"""d as (
  select label, id, sid, word_length, seq, sqrt({_SQUARES}) as dist
  from t join tpl using (word_length, seq))"""

# literally: every distance of length 6 with every distance of length 7 of the same record
MERGED = """merged as (
  select label, id, sid, d6.dist as dist6, d7.dist as dist7
  from (select * from d where word_length = 6) d6
  join (select * from d where word_length = 7) d7 using (id, sid, label)),
dist as (
  select label, id, sid, count(*) as pairs, sum(dist6) as total6, sum(dist7) as total7,
         sqrt(sum(dist6)) / count(id) as dist6, sqrt(sum(dist7)) / count(id) as dist7
  from merged group by label, id, sid)"""

# skewness from central moments: a second pass over the points keeps it accurate
STATS = """m as (
  select label, id, sid, avg(x) as mean, min(x) as min, max(x) as max, stddev_samp(x) as stdev,
         case when max(x) > min(x) then kurtosis_pop(x) end as kurt,
         var_samp(x) as variance, sum(x) as sum, max(x) - min(x) as range
  from pts group by label, id, sid),
stats as (
  select m.label, m.id, m.sid, any_value(m.mean) as mean, any_value(m.min) as min,
         any_value(m.max) as max, any_value(m.stdev) as stdev, any_value(m.kurt) as kurt,
         avg((x - m.mean) ** 3) / nullif(avg((x - m.mean) ** 2) ** 1.5, 0) as skew,
         any_value(m.variance) as variance, any_value(m.sum) as sum, any_value(m.range) as range
  from pts join m using (label, id, sid) group by m.label, m.id, m.sid)"""

# each kind of spoilt message, with its text taken apart; copies are rejected twice
REJECTS = """
with k as (select vec_id % 97 as kind, *, unnest(range(1 + cast(vec_id % 97 = 4 as int))) as copy from embeddings)
select case kind when 1 then 'bad_json' when 2 then 'bad_number' when 3 then 'null_key'
                 else 'duplicate_key' end as reason,
       case when kind > 1 then cast(label % 2 as varchar) end as label,
       case when kind > 1 then cast(vec_id as varchar) end as id,
       case when kind in (2, 4) then 'w0' end as sid,
       case when kind = 1 then 'not json ' || vec_id end as message,
       case kind when 1 then 1 when 2 then len(embedding) + 1 else len(embedding) end as n_parts,
       case when kind > 1 then round(cast(embedding[1] as double) + 1e-9, 6) end as "first",
       case when kind = 2 then 'x' end as "last"
from k where kind in (1, 2, 3, 4)"""

_NAMES = ["mean", "min", "max", "stdev", "kurt", "skew", "variance", "sum", "range"]

GUESSES = """g as (
  select cast(l_suppkey % 2 as int) as label, cast(l_suppkey as varchar) as id, l_returnflag as sid,
         case when avg(l_extendedprice) > 50000 then 1.0 else 0.0 end as prediction
  from lineitem group by l_suppkey, l_returnflag)"""

CELLS = """select {group}
  count(*) filter (where label = 1 and prediction = 1) as tp,
  count(*) filter (where label = 1 and prediction = 0) as fn,
  count(*) filter (where label = 0 and prediction = 1) as fp,
  count(*) filter (where label = 0 and prediction = 0) as tn,
  count(*) as total, count(*) filter (where label = prediction) as hits
  from g"""


def _ratio(x: str, y: str) -> str:
    return f"case when ({y}) = 0 then cast('nan' as double) else ({x}) / ({y}) end"


_F1 = """case when tp = 0 and (fp = 0 or fn = 0) then cast('nan' as double)
              when tp = 0 then 0.0
              else 2 / (1 / (tp / (tp + fp)) + 1 / (tp / (tp + fn))) end"""


_FEATURES = [*_NAMES, "dist6", "dist7"]

# the best split of the training rows, 100 or more on each side, by one feature: the least Gini impurity, the first
# feature, the least value
STUMP = f"""f as (
  select cast(label as int) as y, stats.id, stats.sid, {", ".join(f"coalesce({n}, cast('nan' as double)) as {n}" for n in _FEATURES)},
         cast(id as bigint) % 7 = 0 as testing
  from stats join dist using (label, id, sid)),
long as (
  {" union all ".join(f"select {j} as j, {n} as v, y from f where not testing" for j, n in enumerate(_FEATURES))}),
steps as (
  select j, v, lead(v) over w as following, sum(sum(1 - y)) over w as l0, sum(sum(y)) over w as l1,
         sum(sum(1 - y)) over (partition by j) as t0, sum(sum(y)) over (partition by j) as t1
  from long group by j, v window w as (partition by j order by v)),
gains as (
  select *, (v + following) / 2 as threshold, l0 + l1 as ln, t0 + t1 - l0 - l1 as rn
  from steps where following is not null and least(l0 + l1, t0 + t1 - l0 - l1) >= 100),
split as (
  select * from gains
  order by (1 - (l0 / ln) ** 2 - (l1 / ln) ** 2) * ln / (t0 + t1)
         + (1 - ((t0 - l0) / rn) ** 2 - ((t1 - l1) / rn) ** 2) * rn / (t0 + t1), j, v limit 1),
scored as (
  select f.y, f.id, f.sid, f.testing,
         case when (l1 / ln > 0.5) = ((t1 - l1) / rn > 0.5) then t1 / (t0 + t1) -- leaves that agree are one
              when x <= threshold then l1 / ln else (t1 - l1) / rn end as p1
  from (select *, case (select j from split) {" ".join(f"when {j} then {n}" for j, n in enumerate(_FEATURES))} end as x from f) f, split)"""


# what a batch of all messages, some of them spoilt, holds
BATCH = """k as (select vec_id % 97 as kind, len(embedding) as n, 1 + cast(vec_id % 97 = 4 as int) as copies from embeddings),
b as (
  select cast(sum(copies) as bigint) as n_messages,
         count(*) filter (where kind not in (1, 2, 3, 4)) as n_records,
         cast(sum(copies) filter (where kind in (1, 2, 3, 4)) as bigint) as n_rejects,
         cast(sum(copies * n) filter (where kind not in (1, 2, 3)) as bigint) as n_points,
         (select count(*) from dist where cast(id as bigint) % 97 not in (1, 2, 3, 4)) as n_features,
         (select count(*) from dist where cast(id as bigint) % 97 not in (1, 2, 3, 4) and cast(id as bigint) % 7 = 0) as n_scored
  from k)"""


def _with(*parts: str) -> str:
    return "with " + ",\n".join(parts) + "\n"


# rounded values are moved off their ties first (as in the queries): engines add up in other orders
def _rounded(names, digits: int = 6) -> str:
    return ", ".join(f"round({n} + 1e-9, {digits}) as {n}" for n in names)


def _sql() -> dict[str, str]:
    to_letters = (SMOOTH, LETTERED)
    compared = (*to_letters, all_transitions(), TEMPLATES)
    probs = ", ".join(f"p{c} as {c}" for c in LETTERS)
    pooled = ", ".join(f"round(r{c} + 1e-9, 6) as {c}" for c in LETTERS)
    s16 = ", ".join(
        f"lead(s, {i - 1}) over (partition by id, sid order by pos) as s{i}" for i in range(1, 7)
    )
    columns = f"cols as (select label, sid, id, {s16} from lettered)"
    prefix = "label, sid, id, s1, s2, s3, s4, s5"
    kinds = "vec as (select *, cast(id as bigint) % 97 as kind from pts)"
    features = f"""select label, id, sid, {_rounded([n for n in _NAMES if n != 'variance'])},
      round(variance + 1e-4, 2) as variance, round(dist6 + 1e-9, 6) as dist6, round(dist7 + 1e-9, 6) as dist7
      from stats join dist using (label, id, sid)"""
    numbered = ", ".join(
        f"round(coalesce({n}, cast('nan' as double)) + 1e-9, 6) as f{i + 1}"
        for i, n in enumerate([*_NAMES, "dist6", "dist7"])
    )
    return {
        "ingest_records": _with(EMBEDDINGS, kinds)
        + "select label, id, sid, pos, x from vec where kind not in (1, 2, 3, 4)",
        "ingest_rejects": REJECTS,
        "stream_rejects": REJECTS,
        "batch_profile": """
with k as (select vec_id % 97 as kind, len(embedding) as n,
                  1 + cast(vec_id % 97 = 4 as int) as copies from embeddings)
select cast(sum(copies) as bigint) as n_messages,
       count(*) filter (where kind not in (1, 2, 3, 4)) as n_records,
       cast(sum(copies) filter (where kind in (1, 2, 3, 4)) as bigint) as n_rejects,
       cast(sum(n) filter (where kind not in (1, 2, 3, 4)) as bigint) as n_points
from k""",
        "schema_profile": """
with c as (select count(*) as n, count(event_id) as c0, count(ts) as c1, count(user_id) as c2,
                  count(event_type) as c3, count(value) as c4, count(props) as c5 from events),
     d as (select row_number() over () - 1 as position, column_name, column_type
           from (describe select * from events))
select cast(position as int) as position, column_name as "column",
       case column_type when 'BIGINT' then 'bigint' when 'VARCHAR' then 'string'
                        when 'DOUBLE' then 'double' when 'TIMESTAMP' then 'timestamp_ntz'
                        else column_type end as type,
       n - case position when 0 then c0 when 1 then c1 when 2 then c2 when 3 then c3
                         when 4 then c4 else c5 end as n_null
from d, c""",
        "result_sink": _with(
            GUESSES,
            "c as ("
            + CELLS.format(group="cast(id as bigint) % 3 as batch_id,")
            + " group by cast(id as bigint) % 3)",
            "sinks as (select 'log' as sink, * from c union all select 'latest', * from c where batch_id = 2)",
        )
        + f"""select sink, batch_id, round({_ratio('hits', 'total')} + 1e-9, 6) as accuracy,
        round({_ratio('tp', 'tp + fn')} + 1e-9, 6) as sensitivity,
        round({_ratio('tn', 'tn + fp')} + 1e-9, 6) as specificity, round({_F1} + 1e-9, 6) as f1 from sinks""",
        "transition_sink": _with(EVENTS, *to_letters, all_transitions())
        + f"""select cast(id as bigint) % 3 as batch_id, label, sid, id, word_length, {probs}, seq as "SEQ",
             hex(seq) as "HEX" from t""",
        "explode_points": _with(LINEITEM) + "select label, id, sid, pos, x from pts",
        "moving_average": _with(LINEITEM, SMOOTH)
        + 'select label, id, sid, pos, x, round(ma + 1e-9, 6) as "smoothed_x" from ma',
        "quantile_breakpoints": _with(LINEITEM, SMOOTH)
        + "select id, "
        + ", ".join(f"round(q[{i}] + 1e-9, 6) as q{i}" for i in range(1, 5))
        + " from q",
        "quantiles_sql": _with(EVENTS, SMOOTH)
        + "select id, "
        + ", ".join(f"round(q[{i}] + 1e-9, 6) as q{i}" for i in range(1, 5))
        + ", row_number() over (order by id) as position from q",
        "quantiles_by_batch": _with(
            EVENTS,
            """b as (select id, length(sid) % 2 as batch_id, avg(x) over (partition by id, length(sid) % 2 order by sid, pos
                         rows between 16 preceding and current row) as ma from pts),
        q as (select id, batch_id, quantile_disc(ma, [0.2, 0.4, 0.6, 0.8]) as q from b group by id, batch_id)""",
        )
        + "select id, batch_id, "
        + ", ".join(f"round(q[{i}] + 1e-9, 6) as q{i}" for i in range(1, 5))
        + " from q",
        "quantiles_hot": """
with h as (select case when l_suppkey % 10 < 7 then 'hot' else cast(l_suppkey as varchar) end as id, l_extendedprice as x from lineitem),
     q as (select id, quantile_disc(cast(x as double), [0.2, 0.4, 0.6, 0.8]) as q from h group by id)
select id, """
        + ", ".join(f"round(q[{i}] + 1e-9, 6) as q{i}" for i in range(1, 5))
        + " from q",
        "ordered_points": _with(EVENTS)
        + "select label, id, sid, pos, x, row_number() over (order by x, id, sid, pos) as position from pts",
        "sax_symbols": _with(LINEITEM, *to_letters)
        + "select label, id, sid, pos, x, s as letter from lettered",
        "sax_words": _with(EVENTS, *to_letters)
        + """select label, id, sid, pos, string_agg(s, '') over (partition by id, sid order by pos
             rows between current row and 5 following) as word from lettered""",
        "word_columns": _with(EVENTS, *to_letters, columns) + "select * from cols",
        "prefix_totals": _with(EVENTS, *to_letters, columns)
        + f'select {prefix}, count(*) as "n_prefix" from cols group by {prefix}',
        "transition_counts": _with(EVENTS, *to_letters, columns)
        + f'select {prefix}, s6, count(*) as "n_word" from cols group by {prefix}, s6',
        "transition_pivot": _with(EVENTS, *to_letters, words(6))
        + "select label, sid, id, "
        + ", ".join(
            f"nullif(count(*) filter (where nx = '{c}'), 0) / count(*) as {c}" for c in LETTERS
        )
        + """, seq as "SEQ", hex(seq) as "HEX" from w6 where length(seq) = 5
             group by label, sid, id, seq""",
        "transition_probs": _with(LINEITEM, *to_letters, all_transitions((2, 3, 6, 7)))
        + f'select label, sid, id, word_length, {probs}, seq as "SEQ", hex(seq) as "HEX" from t',
        "word_keys": _with(LINEITEM, *to_letters, all_transitions())
        + """select word_length, seq as "SEQ", hex(seq) as "HEX", count(*) as n_records
             from t group by word_length, seq""",
        "template_build": _with(LINEITEM, *compared)
        + f'select word_length, seq as "SEQ", hex(seq) as "HEX", {pooled} from tpl',
        "template_rows": _with(EVENTS, *to_letters, all_transitions())
        + f"""select word_length, seq as "SEQ", hex(seq) as "HEX", {probs}, count(*) as weight
             from t where {COHORT} group by word_length, seq, {", ".join(f"p{c}" for c in LETTERS)}""",
        "template_read": _with(EVENTS, *compared)
        + f'select word_length, seq as "SEQ", hex(seq) as "HEX", {pooled} from tpl',
        "template_match": _with(EVENTS, *compared)
        + f"""select label, id, sid, word_length, seq as "SEQ", {probs},
             {", ".join(f'round(r{c} + 1e-9, 6) as "t{c}"' for c in LETTERS)}
             from t join tpl using (word_length, seq)""",
        "template_distance": _with(LINEITEM, *compared, DISTANCES)
        + """select label, id, sid, word_length, seq as "SEQ", hex(seq) as "HEX",
             round(dist + 1e-9, 6) as dist from d""",
        "distances_sql": _with(EVENTS, *compared, DISTANCES)
        + """select label, id, sid, word_length, seq as "SEQ", round(dist + 1e-9, 6) as dist from d""",
        "letters_sql": _with(EMBEDDINGS, *to_letters) + "select id, cast(pos as int) as pos, s as letter from lettered",
        "merge_lengths": _with(EVENTS, *compared, DISTANCES, MERGED)
        + """select label, id, sid, cast(pairs as double) as pairs,
             round(total6 + 1e-9, 6) as dist6_total, round(total7 + 1e-9, 6) as dist7_total from dist""",
        "distance_reduce": _with(EVENTS, *compared, DISTANCES)
        + """select label, id, sid, word_length, round(sqrt(sum(dist)) / count(id) + 1e-9, 6) as dist
             from d group by label, id, sid, word_length""",
        "distance_features": _with(LINEITEM, *compared, DISTANCES, MERGED)
        + "select label, id, sid, round(dist6 + 1e-9, 6) as dist6, round(dist7 + 1e-9, 6) as dist7 from dist",
        "stats_window": _with(EVENTS, STATS)
        + f"""select label, id, sid, pos, x, {_rounded(_NAMES[:-1])}
             from pts join stats using (label, id, sid)""",
        "descriptives": _with(EVENTS, STATS)
        + f"select label, id, sid, {_rounded(_NAMES)} from stats",
        "feature_table": _with(LINEITEM, *compared, DISTANCES, MERGED, STATS) + features,
        "feature_vector": _with(EVENTS, *compared, DISTANCES, MERGED, STATS)
        + f"select label, id, sid, {numbered} from stats join dist using (label, id, sid)",
        "split_by_id": f"""
select distinct cast(user_id % 2 as int) as label, cast(user_id as varchar) as id,
       event_type as sid,
       case when cast(user_id as bigint) % 7 = 0 then 'testing' else 'training' end as part
from events""",
        "confusion": _with(GUESSES) + CELLS.format(group=""),
        "metrics": _with(GUESSES, "c as (" + CELLS.format(group="") + ")")
        + f"""select round({_ratio('hits', 'total')} + 1e-9, 6) as accuracy,
        round({_ratio('tp + tn', 'total')} + 1e-9, 6) as acc,
        round({_ratio('tp', 'tp + fp')} + 1e-9, 6) as precision,
        round({_ratio('tp', 'tp + fn')} + 1e-9, 6) as recall,
        round({_ratio('tp', 'tp + fn')} + 1e-9, 6) as sensitivity,
        round({_ratio('tn', 'tn + fp')} + 1e-9, 6) as specificity, round({_F1} + 1e-9, 6) as f1 from c""",
        "rf_train": _with(EMBEDDINGS, *compared, DISTANCES, MERGED)
        + """, k as (select cast(('0x' || substr(md5(id), 1, 8))::bigint % 10 as int) as fold from dist
        where cast(id as bigint) % 7 <> 0)
        select fold, (select count(*) from k) - count(*) as training, count(*) as validation from k group by fold""",
        "stump_score": _with(EMBEDDINGS, *compared, DISTANCES, MERGED, STATS, STUMP)
        + """select y as label, id, sid, round(1 - p1 + 1e-9, 6) as p0, round(p1 + 1e-9, 6) as p1,
        cast(p1 > 0.5 as double) as prediction from scored where testing""",
        "stream_restart": _with(EMBEDDINGS, *compared, DISTANCES, MERGED, STATS, STUMP)
        + """select cast(y as varchar) as label, id, sid, round(1 - p1 + 1e-9, 6) as p0, round(p1 + 1e-9, 6) as p1,
        cast(p1 > 0.5 as double) as prediction, cast(1 as bigint) as n_features from scored""",
        "pipeline_batch": _with(
            EMBEDDINGS,
            *compared,
            DISTANCES,
            MERGED,
            STATS,
            STUMP,
            "g as (select y as label, cast(p1 > 0.5 as double) as prediction from scored "
            "where testing and cast(id as bigint) % 97 not in (1, 2, 3, 4))",
            "c as (" + CELLS.format(group="") + ")",
        )
        + f"""select cast(0 as bigint) as batch_id, total as n_scored, round({_ratio('hits', 'total')} + 1e-9, 6) as accuracy,
        round({_ratio('tp', 'tp + fn')} + 1e-9, 6) as sensitivity,
        round({_ratio('tn', 'tn + fp')} + 1e-9, 6) as specificity, round({_F1} + 1e-9, 6) as f1 from c""",
        "batch_metrics": _with(EMBEDDINGS, *compared, DISTANCES, MERGED, BATCH)
        + """select cast(0 as bigint) as batch_id, unnest(['messages', 'records', 'rejects', 'points', 'features', 'scored']) as stage,
        unnest([n_messages, n_records, n_rejects, n_points, n_features, n_scored]) as n from b""",
        "stream_progress": _with(EMBEDDINGS, *compared, DISTANCES, MERGED, BATCH)
        + "select n_messages, n_records, n_rejects, n_points, n_features from b",
        "stream_features": _with(EMBEDDINGS, *compared, DISTANCES, MERGED, STATS)
        + f"""select label, id, sid, {_rounded([*_NAMES, 'dist6', 'dist7'])}
        from stats join dist using (label, id, sid)""",
    }


ORACLE_SQL: dict[str, str] = _sql()
