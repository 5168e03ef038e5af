"""Repair of the structure of conversations by depth-first branch-and-bound.

A conversation should read `(s?(ua)+)?`: nothing, or a system turn perhaps and then user and assistant in turn. Rows
are kept, given another role, deleted, or joined by inserted ones, at the least cost, and of equally cheap repairs by the
ASCII-least audit, the initials of the edits in order.

The search works on one code per row, never on texts. Rows are sorted globally and cut into segments of at most `SEGMENT`
distinct rows, so that a conversation that owns a third of all rows is searched by many tasks: a segment yields the
cheapest edits for each state of the grammar before and after it. Folding the segments of a conversation in order then chooses
among those. (Of two audits over the same rows that lead to the same state at the same cost neither is a prefix of the other, as
the longer would hold more inserted rows; so replacing a part by a smaller one makes the whole smaller.)
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ratestrata.llm.checksums import crc32_sql
from ratestrata.llm.common import Workspace, let_workers_import

#: Rows of a segment: consecutive places of the global order whose numbers share all but the last bits.
SEGMENT_BITS = 6
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: States of the grammar: nothing yet, after a system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
STEPS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
#: The role that an inserted or reroled turn takes in a state, and the state after it.
NEXT = {START: ("user", USER), SYSTEM: ("user", USER), ASSISTANT: ("user", USER), USER: ("assistant", ASSISTANT)}

Row = tuple[str, bool, bool]  # initial of the role, must be deleted, truncated


def bounds(rows: list[Row]) -> tuple[list[int], list[int]]:
    """What the rows from each place on cost at least: where a system turn could still be kept, and where not.

    A row that must go costs `DELETE`, as does a truncated one at least; a foreign role costs `REROLE`. Two neighbours among
    the rest of one initial cost 1 more, as not both can be kept without a row inserted between them.
    """
    out = []
    for foreign in ("sua", "ua"):
        least, free = [0], None  # `free`: the next row that can stay, if it is unpaired and costs nothing yet
        for initial, must, truncated in reversed(rows):
            cost = DELETE if must or truncated else KEEP if initial and initial in foreign else REROLE
            if not must:
                if cost == KEEP and free == initial:
                    cost, free = 1, None
                else:
                    free = initial if cost == KEEP else None
            least.append(least[-1] + cost)
        out.append(least[::-1])
    return out[0], out[1]


def straight(rows: list[Row], state: int, goals: tuple[int, ...], closing: bool) -> tuple[int, str] | None:
    """A repair found without search: the first incumbent."""
    cost, audit = 0, ""
    for initial, must, truncated in rows:
        if must or truncated:
            cost, audit = cost + DELETE, audit + "D"
        elif (state, initial) in STEPS:
            state, audit = STEPS[state, initial], audit + "K"
        else:
            state, cost, audit = NEXT[state][1], cost + REROLE, audit + "R"
    while closing and state not in goals:
        state, cost, audit = NEXT[state][1], cost + INSERT, audit + "I"
    return (cost, audit) if state in goals else None


def cheapest(rows: list[Row], entry: int, goals: tuple[int, ...], closing: bool) -> tuple[int, str] | None:
    """The cheapest `(cost, audit)` that leads from `entry` over the rows to one of `goals`; rows are inserted behind the last if `closing`.

    Depth-first with an explicit stack, edits in ASCII order. A prefix is given up if its cost and the least that the rest
    costs pass the incumbent, or reach it with a larger audit. The table of each node (place, state) holds the cheapest prefix that reached it:
    prefixes come in ASCII order, so a later one survives only if it is strictly cheaper. What is left when the stack is empty is proved best.
    """
    n, (fresh, inner) = len(rows), bounds(rows)
    incumbent = straight(rows, entry, goals, closing)
    table: dict[tuple[int, int], int] = {}
    stack = [(0, entry, 0, "")]
    while stack:
        i, state, cost, audit = stack.pop()
        if incumbent is not None:
            least = cost + (fresh if state == START else inner)[i]
            if least > incumbent[0] or (least == incumbent[0] and audit > incumbent[1]):
                continue
        if table.get((i, state), cost + 1) <= cost:
            continue
        table[i, state] = cost
        if i == n:
            if state in goals and (incumbent is None or (cost, audit) < incumbent):
                incumbent = cost, audit
            if closing:
                stack.append((i, NEXT[state][1], cost + INSERT, audit + "I"))
            continue
        initial, must, truncated = rows[i]
        if not must:
            more = cost + (TRUNCATED if truncated else 0)
            stack.append((i + 1, NEXT[state][1], more + REROLE, audit + "R"))
            if (state, initial) in STEPS:
                stack.append((i + 1, STEPS[state, initial], more + KEEP, audit + "K"))
        stack.append((i, NEXT[state][1], cost + INSERT, audit + "I"))
        stack.append((i + 1, state, cost + DELETE, audit + "D"))
    return incumbent


_WAYS = "array<struct<entry:int,exit:int,cost:long,audit:string>>"


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of rows to their ways: every entry state, every exit state; the last of a conversation ends it."""
    kind = pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
    for batch in batches:
        ways, first, last, illegal = [], [], [], []
        for codes, opens, closes in zip(*(batch.column(c).to_pylist() for c in ("codes", "opens", "closes"))):
            rows = [
                (code["initial"], code["must"] or copy > 0, code["truncated"]) for code in codes for copy in range(code["copies"])
            ]
            found = []
            for entry in (START,) if opens else range(4):
                for goals in (ENDS,) if closes else tuple((state,) for state in range(4)):
                    best = cheapest(rows, entry, goals, closes)
                    if best is not None:
                        found.append({"entry": entry, "exit": -1 if closes else goals[0], "cost": best[0], "audit": best[1]})
            ways.append(found)
            first.append(rows[0][0])
            last.append(rows[-1][0])
            illegal.append(sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])))
        yield pa.record_batch(
            [*(batch.column(c) for c in ("conv_id", "segment", "codes")), pa.array(ways, kind), pa.array(first, pa.string()),
             pa.array(last, pa.string()), pa.array(illegal, pa.int64())],
            names=["conv_id", "segment", "codes", "ways", "first", "last", "illegal"],
        )


def _chosen(ways: list[list[dict]]) -> list[dict]:
    """One way of each segment: the cheapest chain, of equal ones that of the least audit."""
    layers, tails, costs = [], {START: ""}, {START: 0}
    for found in ways:
        best: dict[int, tuple[int, str, dict]] = {}
        for way in found:
            if way["entry"] in costs:
                candidate = costs[way["entry"]] + way["cost"], tails[way["entry"]] + way["audit"], way
                if way["exit"] not in best or candidate[:2] < best[way["exit"]][:2]:
                    best[way["exit"]] = candidate
        same = len(os.path.commonprefix([tail for _, tail, _ in best.values()]))  # what all have in common decides nothing any more
        costs, tails = {k: b[0] for k, b in best.items()}, {k: b[1][same:] for k, b in best.items()}
        layers.append({k: b[2] for k, b in best.items()})
    out, exit_ = [], -1
    for layer in reversed(layers):
        out.append(layer[exit_])
        exit_ = layer[exit_]["entry"]
    return out[::-1]


def _by_conversation(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[tuple[int | None, list[tuple]]]:
    """Rows sorted by conversation, one conversation at a time."""
    at, rows = None, []
    for batch in batches:
        for conv, *row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", *columns))):
            if rows and conv != at:
                yield at, rows
                rows = []
            at = conv
            rows.append(row)
    if rows:
        yield at, rows


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The way taken through each segment, and the illegal neighbours in it and on its border to the one before."""
    out = []

    def flushed() -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.int64())
        names = ["conv_id", "segment", "entry", "cost", "audit", "illegal"]
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    for conv, rows in _by_conversation(batches, ("segment", "ways", "first", "last", "illegal")):
        before = None
        for (segment, _, first, last, illegal), way in zip(rows, _chosen([row[1] for row in rows])):
            illegal += before is not None and before + first not in ("su", "ua", "au")
            before = last
            out.append((conv, segment, way["entry"], way["cost"], way["audit"], illegal))
        if len(out) >= 1000:
            yield flushed()
            out = []
    if out:
        yield flushed()


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per edit: the place of the row it is about (the segment's last for rows inserted behind it), and the new role."""
    for batch in batches:
        out = []
        for conv, segment, entry, audit, codes in zip(
            *(batch.column(c).to_pylist() for c in ("conv_id", "segment", "entry", "audit", "codes"))
        ):
            rows = chain.from_iterable([code] * code["copies"] for code in codes)
            here, state = None, entry
            waiting = []
            for n, edit in enumerate(audit):
                role = None
                if edit in "IR":
                    role, after = NEXT[state]
                if edit == "I":
                    waiting.append((n, role))
                    state = after
                    continue
                code = next(rows)
                here = code["position"]
                out += [(conv, segment, m, here, "I", r) for m, r in waiting]
                waiting = []
                if edit == "R":
                    state = after
                elif edit == "K":
                    state = STEPS[state, code["initial"]]
                out.append((conv, segment, n, here, edit, role))
            out += [(conv, segment, m, here, "I", r) for m, r in waiting]
        if out:
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.string())
            names = ["conv_id", "segment", "step", "position", "edit", "new_role"]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)


@dataclass
class Repair:
    """`summary`: one row per conversation: `conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit`.
    `steps`: one row per edit, in the order of `segment, step`: `conv_id, segment, step, edit, turn, role, text`, role and text as repaired;
    deleted rows (edit D) keep theirs, inserted ones (I) have an empty text and no turn."""

    summary: DataFrame
    steps: DataFrame


def _bare(text: str) -> Column:
    return F.rtrim(F.col(text), F.lit(" \t\n\x0b\f\r"))


def repair(conversations: DataFrame) -> Repair:
    """The cheapest repair of every conversation of `(conv_id, turn, role, text, ...)`.

    Rows count in the order of turn (null first), then role, then text; null roles and texts count as one space. A row's first fault
    counts: blank (ASCII white space only), duplicate (role and text stood earlier), truncated (the last other character
    is none of `.!?`). Blank and duplicate rows are deleted. A null conv_id is a conversation of its own. Repeated rows are duplicates
    of the first; they are counted, not copied, until their edits are written. An empty table gives empty results.

    Only codes of rows meet in one task for a whole conversation, and its audit, which is one cell.
    """
    spark = conversations.sparkSession
    let_workers_import(spark)
    work = Workspace(spark, "conversation-repair")
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")),
    ).groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    order = ["conv_id", "turn", "role", "text"]
    # the number of a row grows with the global order
    rows = work.store(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("position", F.monotonically_increasing_id()), "rows"
    )
    bare = _bare("text")
    codes = rows.select(
        "position", "conv_id", "turn", "copies", F.substring("role", 1, 1).alias("initial"), (bare == "").alias("blank"),
        (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("open"),
        F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")).alias("content"),
    )
    first = codes.where("not blank").groupBy("conv_id", "content").agg(F.min("position").alias("first"), F.count("*").alias("n"))
    first = work.store(first.where("n > 1").select(F.col("conv_id").alias("c"), F.col("content").alias("x"), "first"), "first")
    codes = codes.join(first, codes.conv_id.eqNullSafe(F.col("c")) & (codes.content == F.col("x")), "left").select(
        "position", "conv_id", "turn", "copies", "initial", "blank",
        (~F.col("blank") & (F.col("position") > F.coalesce("first", "position"))).alias("duplicate"), "open",
    ).withColumn("truncated", ~F.col("blank") & ~F.col("duplicate") & F.col("open"))
    codes = work.store(codes, "codes")

    count = lambda flag: F.sum(F.when(F.col(flag), F.col("copies")).otherwise(0))
    again = F.sum(F.when(~F.col("blank"), F.col("copies") - 1).otherwise(0))
    turns = codes.where("turn is not null").select("conv_id", "turn").distinct().groupBy(F.col("conv_id").alias("t")).agg(
        (F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gaps")
    )
    faults = codes.groupBy("conv_id").agg(
        F.min("position").alias("low"), F.max("position").alias("high"), count("blank").alias("blank"),
        (F.sum(F.when(F.col("duplicate"), 1).otherwise(0)) + again).alias("duplicate"),
        F.sum(F.when(F.col("truncated"), 1).otherwise(0)).alias("truncated"),
    )
    faults = work.store(faults, "faults")
    borders = faults.select(F.col("conv_id").alias("c"), *(F.shiftright(x, SEGMENT_BITS).alias(x) for x in ("low", "high")))
    code = F.struct("position", "initial", (F.col("blank") | F.col("duplicate")).alias("must"), "truncated", F.col("copies").cast("int").alias("copies"))
    segments = codes.groupBy("conv_id", F.shiftright("position", SEGMENT_BITS).alias("segment")).agg(F.sort_array(F.collect_list(code)).alias("codes"))
    segments = segments.join(borders, segments.conv_id.eqNullSafe(F.col("c"))).select(
        "conv_id", "segment", "codes", (F.col("segment") == F.col("low")).alias("opens"), (F.col("segment") == F.col("high")).alias("closes")
    )
    code_kind = "array<struct<position:long,initial:string,must:boolean,truncated:boolean,copies:int>>"
    searched = work.store(segments.mapInArrow(
        _searched, f"conv_id long, segment long, codes {code_kind}, ways {_WAYS}, first string, last string, illegal long"
    ), "searched")
    folded = searched.drop("codes").repartition("conv_id").sortWithinPartitions("conv_id", "segment").mapInArrow(
        _folded, "conv_id long, segment long, entry int, cost long, audit string, illegal long"
    )
    folded = work.store(folded, "folded")

    total = folded.groupBy(F.col("conv_id").alias("f")).agg(
        F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("segment", "audit"))), lambda x: x.audit), "").alias("audit"),
    )
    summary = (
        faults.join(total, faults.conv_id.eqNullSafe(F.col("f"))).join(turns, faults.conv_id.eqNullSafe(F.col("t")), "left")
        .select("conv_id", F.coalesce("gaps", F.lit(0)).alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    )
    same = [folded.conv_id.eqNullSafe(searched.conv_id), folded.segment == searched.segment]
    edits = folded.join(searched.select("conv_id", "segment", "codes"), same[0] & same[1]).select(
        folded.conv_id, folded.segment, "entry", "audit", "codes"
    ).mapInArrow(_edits, "conv_id long, segment long, step int, position long, edit string, new_role string")
    added = F.col("edit") == "I"
    steps = edits.join(rows.select("position", "turn", "role", "text"), "position").select(
        "conv_id", "segment", "step", "edit", F.when(~added, F.col("turn")).alias("turn"),
        F.coalesce("new_role", "role").alias("role"), F.when(added, "").otherwise(F.col("text")).alias("text"),
    )
    return Repair(summary, steps)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows of `conversations` with faults planted by a checksum of `conv_id:turn`; nulls become one space, but for the ids themselves."""
    texts = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    fault = (F.crc32(F.concat(texts["conv_id"], F.lit(":"), texts["turn"]).cast("binary")) % 20).alias("fault")
    rows = conversations.select("conv_id", "turn", texts["role"].alias("role"), texts["text"].alias("text"), fault).where("fault != 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    return rows.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.expr("sequence(1, if(fault = 3, 2, 1))")).alias("copy")
    ).drop("copy")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the lines of each conversation, sorted, one line at a time."""
    at, digest, done = None, None, []
    for batch in batches:
        for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
            line = f"{role}:{text}".encode()
            if digest is not None and conv == at:
                digest.update(b"\n" + line)
            else:
                if digest is not None:
                    done.append((at, digest.hexdigest()))
                at, digest = conv, hashlib.sha256(line)
        if done:
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*done), (pa.int64(), pa.string()))], names=["conv_id", "sha"])
            done = []
    if digest is not None:
        yield pa.record_batch([pa.array([at], pa.int64()), pa.array([digest.hexdigest()])], names=["conv_id", "sha"])


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    found = repair(damaged(conversations))
    lines = found.steps.where("edit != 'D'").repartition("conv_id").sortWithinPartitions("conv_id", "segment", "step")
    digests = lines.select("conv_id", "role", "text").mapInArrow(_hashed, "conv_id long, sha string").withColumnRenamed("conv_id", "d")
    every = conversations.select(F.col("conv_id").cast("long").alias("every")).distinct()
    counts = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return (
        every.join(found.summary, F.col("every").eqNullSafe(F.col("conv_id")), "left")
        .join(digests, F.col("every").eqNullSafe(F.col("d")), "left")
        .select(
            F.col("every").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
        )
    )


def _more(state: str, cost: str, letter: str) -> str:
    return f"(lpad(CAST(CAST(left({state}, 9) AS BIGINT) + {cost} AS VARCHAR), 9, '0') || substr({state}, 10) || '{letter}')"


def _sql() -> str:
    """Forward over the rows: for each state of the grammar the least text of a nine-digit cost and the audit."""
    s = [f"s{k}" for k in range(4)]
    inserted = [_more(x, "5", "I") for x in s]
    open_ = {
        "t0": "s0", "t1": "s1", "t2": f"least(s2, {inserted[0]}, {inserted[1]}, {inserted[3]})",
        "t3": f"least(s3, {inserted[2]}, {_more(inserted[0], '5', 'I')}, {_more(inserted[1], '5', 'I')})",
    }
    late = "CASE WHEN truncated THEN 5 ELSE 0 END"

    def step(to: int, sources: list[int], initial: str) -> str:
        ways = [_more(f"t{to}", "2", "D")]
        for k in sources:
            ways.append(f"CASE WHEN NOT must AND initial = '{initial}' THEN {_more(f't{k}', late, 'K')} END")
            if initial != "s":
                ways.append(f"CASE WHEN NOT must THEN {_more(f't{k}', f'1 + {late}', 'R')} END")
        return f"least({', '.join(ways)}) AS s{to}"

    steps = ", ".join([f"{_more('t0', '2', 'D')} AS s0", step(1, [0], "s"), step(2, [0, 1, 3], "u"), step(3, [2], "a")])
    opened = ", ".join(f"{v} AS {k}" for k, v in open_.items())
    return rf"""
WITH RECURSIVE faults AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc32_sql("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS fault
  FROM conversations
), damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN fault = 3 THEN 2 ELSE 1 END)) AS copy
  FROM faults WHERE fault <> 0
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged
), ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
    regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS bare, left(role, 1) AS initial
  FROM numbered
), judged AS (
  SELECT conv_id, turn, role, text, i, initial, bare = '' AS blank, bare <> '' AND again AS duplicate,
    bare <> '' AND NOT again AND right(bare, 1) NOT IN ('.', '!', '?') AS truncated, bare = '' OR again AS must,
    coalesce(lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial NOT IN ('su', 'ua', 'au'), false) AS illegal
  FROM ordered
), path AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, '000000000' AS s0, CAST(NULL AS VARCHAR) AS s1, CAST(NULL AS VARCHAR) AS s2, CAST(NULL AS VARCHAR) AS s3
  FROM (SELECT DISTINCT conv_id FROM judged)
  UNION ALL
  SELECT conv_id, i, {steps} FROM (
    SELECT j.conv_id, j.i, j.initial, j.must, j.truncated, {opened}
    FROM path p JOIN judged j ON j.conv_id IS NOT DISTINCT FROM p.conv_id AND j.i = p.i + 1
  )
), best AS (
  SELECT conv_id, least(t0, t3) AS best FROM (
    SELECT p.conv_id, {opened} FROM path p JOIN (SELECT conv_id, max(i) AS i FROM judged GROUP BY conv_id) n
      ON n.conv_id IS NOT DISTINCT FROM p.conv_id AND n.i = p.i
  )
), letters AS (
  SELECT conv_id, unnest(range(10, length(best) + 1)) AS place, substr(best, unnest(range(10, length(best) + 1)), 1) AS edit FROM best
), placed AS (
  SELECT *, count(*) FILTER (WHERE edit <> 'I') OVER w AS i, count(*) FILTER (WHERE edit <> 'D') OVER w AS kept
  FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY place)
), lines AS (
  SELECT p.conv_id, p.place, p.edit, p.kept, CASE WHEN p.edit = 'K' THEN j.role END AS role, CASE WHEN p.edit = 'I' THEN '' ELSE j.text END AS text,
    max(CASE WHEN p.kept = 1 AND p.edit = 'K' AND j.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY p.conv_id) AS opened
  FROM placed p LEFT JOIN judged j ON j.conv_id IS NOT DISTINCT FROM p.conv_id AND j.i = p.i
  WHERE p.edit <> 'D'
), repaired AS (
  SELECT conv_id, sha256(string_agg(coalesce(role, CASE WHEN (kept - opened) % 2 = 1 THEN 'user' ELSE 'assistant' END) || ':' || text, chr(10) ORDER BY place)) AS sha
  FROM lines GROUP BY conv_id
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank,
    count(*) FILTER (WHERE duplicate) AS duplicate, count(*) FILTER (WHERE truncated) AS truncated, count(*) FILTER (WHERE illegal) AS illegal
  FROM judged GROUP BY conv_id
)
SELECT e.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
  CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
  CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, coalesce(CAST(left(best, 9) AS BIGINT), 0) AS cost,
  coalesce(substr(best, 10), '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) e
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM e.conv_id
LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM e.conv_id
"""


OP13_SQL = _sql()
