"""Dialogue-shaped inputs over the plain tables, as SQL that Spark and DuckDB both run.

{name} stands for a table or another view.
"""

from __future__ import annotations

import re
import string

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "fx_emotions": "select 'happy' as emotion, 0 as ord union all select 'sad', 1 union all select 'angry', 2 union all select 'neutral', 3",
    "fx_pairs": """select concat(x.conv_id, ':', x.turn) as pair_id, x.conv_id, x.turn, x.text as user_text, x.next_text as agent_text,
        case x.conv_id % 4 when 0 then 'happy' when 1 then 'sad' when 2 then 'angry' else 'neutral' end as curr,
        case (x.conv_id + x.turn) % 4 when 0 then 'happy' when 1 then 'sad' when 2 then 'angry' else 'neutral' end as res
      from (select conv_id, turn, role, text, lead(role) over (partition by conv_id order by turn) as next_role,
        lead(text) over (partition by conv_id order by turn) as next_text from {conversations}) x
      where x.role = 'user' and x.next_role = 'assistant'""",
    "fx_candidates": """select concat('p', conv_id, '_', turn - turn % 2) as id, turn % 2 as attempt,
        case (conv_id + turn) % 4 when 0 then 'happy' when 1 then 'sad' when 2 then 'angry' else 'neutral' end as emotion,
        case (conv_id * 3 + turn) % 8
          when 0 then concat('User: "', text, '"')
          when 1 then concat('```text', chr(10), text, chr(10), '```')
          when 2 then concat('<|emotion:sadness|>', text)
          when 3 then concat('Here is a line: ', text)
          when 4 then concat('I just got great news about ', lower(text), ', I can not stop smiling.')
          when 5 then concat('I am happy ', text)
          else text end as raw_text
      from {conversations}""",
    "fx_clips": """select concat(c.emotion, '_', r.emotion, '_', cu.c_custkey) as id, concat('user_', c.emotion, '_', cu.c_custkey) as user_id,
        c.emotion as curr_emotion, r.emotion as res_emotion,
        concat('/clips/', c.emotion, '_', r.emotion, '_', cu.c_custkey, '.wav') as path,
        2.0e0 + ((cu.c_custkey * 37 + c.ord * 11 + r.ord * 5) % 900) / 10.0e0 as duration
      from {customer} cu cross join {fx_emotions} c cross join {fx_emotions} r
      where (cu.c_custkey + c.ord * 3 + r.ord) % 97 <> 0""",
    "fx_voices": """select s_suppkey as pos, s_name as name,
        case s_suppkey % 5 when 0 then 'F' when 1 then 'M' when 2 then 'F' when 3 then 'M' else '' end as gender from {supplier}""",
    "fx_takes": """select concat('t', vec_id - vec_id % 2) as id, vec_id % 2 as take, embedding as pcm,
        cast(20 + vec_id % 60 as int) as n_chars from {embeddings}""",
    "fx_words": """select l_orderkey as clip,
        row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate) as pos,
        p.p_name as word, (l_linenumber - 1) * 11e0 + (l_partkey % 100) / 10e0 as start_sec,
        (l_linenumber - 1) * 11e0 + (l_partkey % 100) / 10e0 + (l_suppkey % 8) / 10e0 - 0.1e0 as end_sec,
        case l_suppkey % 3 when 0 then 'SPEAKER_CLIENT' else 'SPEAKER_BROKER' end as speaker, cast(l_partkey % 5 as int) as n_tokens
      from {lineitem} l join {part} p on p.p_partkey = l.l_partkey""",
    "fx_injections": """select user_id as clip_no, event_id as pos,
        case when event_type = 'error' then null else cast(floor(value * 3) as int) - 20 end as frame_offset, props as text,
        cast(1 + event_id % 5 as int) as n_tokens from {events}""",
    "fx_token_ce": """select l_orderkey as sample, cast(l_suppkey % 17 as int) as channel, l_linenumber as frame,
        cast(l_partkey % 8 as int) as target, l_returnflag <> 'N' as valid, l_extendedprice / 10000e0 as ce,
        cast(l_suppkey % 5 as int) as prompt_length, l_quantity > 40 as context from {lineitem}""",
    "fx_metrics": "select event_type as tag, event_id as step, ts as at, value as loss from {events}",
    "fx_dialogues": """select f.id, f.user_id, f.curr_emotion, f.res_emotion, cu.c_custkey as pos,
        concat('U ', cu.c_mktsegment, ' ', f.id) as user_text, concat('A ', cu.c_name) as agent_text
      from {fx_clips} f join {customer} cu on f.user_id = concat('user_', f.curr_emotion, '_', cu.c_custkey)""",
}

#: The same rows for Spark alone, where the common text has a condition that Spark can join by nested loops only: what is
#: behind the prefix equals the key, so the join has a key and the text's own condition stays beside it.
SPARK_VIEWS = {
    "fx_dialogues": """select f.id, f.user_id, f.curr_emotion, f.res_emotion, cu.c_custkey as pos,
        concat('U ', cu.c_mktsegment, ' ', f.id) as user_text, concat('A ', cu.c_name) as agent_text
      from {fx_clips} f join {customer} cu on substring(f.user_id, length(concat('user_', f.curr_emotion, '_')) + 1) = cast(cu.c_custkey as string)
        and f.user_id = concat('user_', f.curr_emotion, '_', cu.c_custkey)""",
}


def _names(sql: str) -> list[str]:
    return list(dict.fromkeys(f for _, f, _, _ in string.Formatter().parse(sql) if f))


#: Tables whose few bytes become many rows in a view, with the columns that it reads and the rows of one task: a file of a
#: single row group would be one task, and adaptive execution, which goes by bytes, would leave few.
SPREAD = {"fx_clips": ("customer", ("c_custkey",), 4096), "fx_pairs": ("conversations", ("conv_id", "turn", "role", "text"), 4096)}


def spread(rows: DataFrame, per_task: int, key: str) -> DataFrame:
    """rows dealt by a key to as many tasks as their count asks for."""
    n = -(-rows.count() // per_task)
    return rows.repartition(n, key) if n > 1 else rows


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of sf_dir, or one of VIEWS over its tables."""
    if name not in VIEWS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    sql = SPARK_VIEWS.get(name, VIEWS[name])
    given = {n: view(spark, sf_dir, n) for n in _names(sql)}
    if name in SPREAD:
        table, columns, per_task = SPREAD[name]
        given[table] = spread(given[table].select(*columns), per_task, columns[0])
    return spark.sql(sql, **given)


def with_views(sql: str) -> str:
    """DuckDB text: the views that sql names, in order, before it."""
    order: list[str] = []

    def need(text: str) -> None:
        for n in VIEWS:
            if re.search(rf"\b{n}\b", text) and n not in order:
                need(VIEWS[n])
                if n not in order:
                    order.append(n)

    need(sql)
    views = [f"{n} as ({VIEWS[n].format(**{x: x for x in _names(VIEWS[n])})})" for n in order]
    sql = sql.strip()
    if sql.lower().startswith("with "):
        views.append(sql[5:].strip())
        return "with " + ", ".join(views)
    return f"with {', '.join(views)} {sql}" if views else sql
