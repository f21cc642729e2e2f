"""Repair of conversations: the cheapest edits after which roles read ``(system? (user assistant)+)?``.

Turns are aligned with every feasible length of the alternating grammar string by Wagner-Fischer tables. Counted
from its end, each string is the tail of all longer ones, so one table of suffix costs holds the alignments
with all lengths. A cheap repair gives the incumbent cost; cells that no alignment within it can
pass are left out (Ukkonen's band). Among the cheapest alignments of all lengths the audits are traced in step and
the least in ASCII order is kept.

An ordinary conversation is repaired by the task that holds its rows. A longer one is cut into segments:
each is aligned from every state of the grammar to every other, the segments are chained by their costs, and only the
chosen audits are looked up again, so no task ever holds the rows of such a conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType
from pyspark.sql.window import Window

from .common import map_rows, need, stored

LONG_ROWS = 2048  # conversations with more turns, or more characters, are repaired by segments
LONG_CHARS = 16_000_000
SEGMENT_BITS = 9  # rows of a segment: 512 at most
FEW_KEYS = 100_000  # ids of long conversations are broadcast up to this number, joined by shuffle beyond it
REMEMBERED = 50_000  # alignments of short conversations kept by a task

BLANKS = "\t\n\x0b\x0c\r "
ENDS = (".", "!", "?")
FORCED = "x"  # codes: x must go; s, u, a, o are the roles' initials (o: any other), upper case where truncated
NEVER = 1 << 40

# States of the grammar: nothing yet, after the system turn, assistant due, user due.
START, OPENED, ASSISTANT, USER = range(4)
STATES = (START, OPENED, ASSISTANT, USER)
TAIL = {START: (0, ""), OPENED: (4, "II"), ASSISTANT: (2, "I"), USER: (0, "")}
NAMES = {"u": "user", "a": "assistant"}


def damage(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Rows with faults by ``crc32(conv_id:turn) % 20``; ``times`` says how often a row stands (0: dropped).

    0 drops the row, 1 empties its text, 2 takes away ``.!?``, 3 repeats it, 4 makes it a user's.
    NULL roles, texts and parts of the key are one space; NULL ids and turns stay NULL.
    """
    rows = need(conversations, conv_col, turn_col, role_col, text_col).toDF("conv", "turn", "role", "text")
    kind = F.pmod(F.crc32(F.concat_ws(
        ":", F.coalesce(F.col("conv").cast("string"), F.lit(" ")), F.coalesce(F.col("turn").cast("string"), F.lit(" ")),
    )), F.lit(20))
    text = F.coalesce("text", F.lit(" "))
    return rows.select(
        "conv", "turn",
        F.when(kind == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(kind <= 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("times"),
    )


class Suffixes:
    """Costs of aligning the rows from i on with the last r symbols of the grammar string, within the band.

    ``due`` is the state after the last symbol. With ``final`` symbols may be inserted behind the last row,
    else only before rows. ``costs[i]`` holds lengths from ``low[i]`` on.
    """

    def __init__(self, codes: str, due: int, bound: int, final: bool):
        n = len(codes)
        forced = codes.count(FORCED)
        late = sum(c.isupper() for c in codes)
        self.slack = slack = max(0, (bound - 3 * forced - late) // 2)
        width = 2 * slack + 1
        self.codes, self.n, self.odd = codes, n, "u" if due == ASSISTANT else "a"
        self.even = "a" if due == ASSISTANT else "u"
        self.low = low = [0] * (n + 1)
        low[n] = -slack
        for i in range(n - 1, -1, -1):
            low[i] = low[i + 1] + (codes[i] != FORCED)
        steps = np.arange(width, dtype=np.int64) * 2
        row = np.full(width, NEVER, dtype=np.int64)
        if final:
            row[slack:] = steps[:slack + 1]
        else:
            row[slack] = 0
        self.costs = costs = [row] * (n + 1)
        even = np.zeros(width, dtype=np.int64)
        even[0::2] = 1
        parity = {0: even, 1: 1 - even}  # where the length is even, for an even and an odd lower end
        for i in range(n - 1, -1, -1):
            code = codes[i]
            if code == FORCED:
                new = row + 3
            else:
                # At the same place of the next row stands the length less one, one place on the same length.
                initial = code.lower()
                is_even = parity[low[i] & 1]
                miss = 2 * (1 - is_even) if initial == self.even else 2 * is_even if initial == self.odd else 2
                new = row + miss + (code != initial)
                np.minimum(new[:-1], row[1:] + 3, out=new[:-1])
            if low[i] < 0:
                new[:-low[i]] = NEVER
                if code != FORCED:  # length 0: only deletions
                    zero = -low[i]
                    new[zero] = row[zero + 1] + 3 if zero + 1 < width else NEVER
            elif low[i] == 0 and code != FORCED:
                new[0] = row[1] + 3 if width > 1 else NEVER
            new = np.minimum.accumulate(new - steps) + steps
            if low[i] < 0:
                new[:-low[i]] = NEVER
            row = costs[i] = np.minimum(new, NEVER)

    def cost(self, i: int, r: int) -> int:
        at = r - self.low[i]
        return int(self.costs[i][at]) if r >= 0 and 0 <= at < len(self.costs[i]) else NEVER

    def lengths(self, i: int, odd: bool, least: int) -> Iterator[tuple[int, int]]:
        """Lengths from ``least`` on with the given parity, and their costs."""
        r = max(least, self.low[i])
        r += (r + odd) % 2
        while r < self.low[i] + len(self.costs[i]):
            yield r, int(self.costs[i][r - self.low[i]])
            r += 2

    def moves(self, i: int, r: int) -> Iterator[tuple[str, int, int]]:
        """Edits of least cost from here, in ASCII order, and where they lead."""
        here = self.cost(i, r)
        code = self.codes[i] if i < self.n else None
        if code and here == self.cost(i + 1, r) + 3:
            yield "D", i + 1, r
        if r and here == self.cost(i, r - 1) + 2:
            yield "I", i, r - 1
        if code and code != FORCED and r:
            same = code.lower() == (self.odd if r % 2 else self.even)
            if here == self.cost(i + 1, r - 1) + (0 if same else 2) + (code != code.lower()):
                yield "K" if same else "R", i + 1, r - 1


def incumbent(codes: str, start: int, end: int, final: bool) -> int:
    """Cost of a plain repair from one state to another: mismatched turns are renamed or preceded by an insertion."""
    kept = [c for c in codes if c != FORCED]
    base = 3 * (len(codes) - len(kept)) + sum(c.isupper() for c in kept)
    kept = [c.lower() for c in kept]
    least = 1 if start in (START, OPENED) else 0
    tries = [(kept, least)]
    if start == START and kept[:1] == ["s"] and (final or len(kept) > 1):
        tries.append((kept[1:], 1))
    costs = []
    for turns, least in tries:
        due, cost, symbols = ("a" if start == ASSISTANT else "u"), base, 0
        for i, initial in enumerate(turns):
            other = "a" if due == "u" else "u"
            if initial == due:
                due, symbols = other, symbols + 1
            else:
                cost += 2
                if initial == other and i + 1 < len(turns) and turns[i + 1] == due:
                    symbols += 2
                else:
                    due, symbols = other, symbols + 1
        reached = ASSISTANT if due == "a" else USER
        if reached != end:
            cost += 2 if final and symbols else 4
        elif symbols < least:
            cost += 4
        costs.append(cost)
    return min(costs)


def _trace(table: Suffixes, opened: list[int], cost: int, heads: list[tuple[int, int]], odd: bool) -> str:
    """The least audit among all alignments of this cost; ``heads`` are (row, length), row -1 - i is the start at row i."""
    audit = []
    while True:
        found: dict[str, set[tuple[int, int]]] = {}
        for i, r in heads:
            if i >= 0:
                if i == table.n and r == 0:
                    return "".join(audit)
                for edit, j, q in table.moves(i, r):
                    found.setdefault(edit, set()).add((j, q))
                    break  # later edits of this place are greater
                continue
            at = -1 - i  # nothing kept yet: deletions, then the system turn
            if cost - 3 >= 0 and opened[at + 1] == cost - 3:
                found.setdefault("D", set()).add((-2 - at, 0))
            code = table.codes[at]
            if code in ("s", "S"):
                rest = cost - (code == "S")
                ends = {(at + 1, r) for r, c in table.lengths(at + 1, odd, 1) if c == rest}
                if ends:
                    found.setdefault("K", set()).update(ends)
        edit = min(found)
        if any(i < 0 for i, _ in found[edit]):
            cost -= 3
        audit.append(edit)
        heads = list(found[edit])


def align(codes: str, start: int, ends: tuple[int, ...], final: bool, tables: dict | None = None) -> dict[int, tuple[int, str]]:
    """(cost, audit) of the cheapest edits from ``start`` to each end, ties to the least audit.

    With ``final`` the only end is USER and stands for the end of a whole conversation.
    """
    n, out = len(codes), {}
    none = (3 * n, "D" * n)
    for end in ends:
        if end in (START, OPENED) and not final:
            if start == end:
                out[end] = none
            elif start == START and end == OPENED:
                places = [(code == "S", -i) for i, code in enumerate(codes) if code in "sS"]
                if places:
                    late, at = min(places)
                    out[end] = 3 * (n - 1) + late, "D" * -at + "K" + "D" * (n - 1 + at)
            continue
        odd = (start == ASSISTANT) != (end == ASSISTANT)
        least = 0 if start in (ASSISTANT, USER) else 1
        if final and start == START:
            least = 0
        key = (end, final)
        if tables is None or key not in tables:
            starts = STATES if tables is not None else (start,)
            table = Suffixes(codes, end, max(incumbent(codes, s, end, final) for s in starts), final)
            if tables is not None:
                tables[key] = table
        else:
            table = tables[key]
        choices = list(table.lengths(0, odd, least))
        opened = [NEVER] * (n + 1)
        if start == START:
            for i in range(n - 1, -1, -1):
                kept = NEVER
                if codes[i] in "sS":
                    kept = min((c for _, c in table.lengths(i + 1, end == ASSISTANT, 1)), default=NEVER) + (codes[i] == "S")
                opened[i] = min(NEVER, opened[i + 1] + 3, kept)
        cost = min([opened[0]] + [c for _, c in choices])
        if cost >= NEVER:
            continue
        heads = [(0, r) for r, c in choices if c == cost]
        if opened[0] == cost:
            heads.append((-1, 0))
        out[end] = cost, _trace(table, opened, cost, heads, end == ASSISTANT)
    return out


def align_whole(codes: str) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    return align(codes, START, (USER,), True)[USER] if codes else (0, "")


def align_segment(codes: str) -> dict[tuple[int, int], tuple[int, str]]:
    """Cost and audit of a part of a conversation from every state to every other."""
    tables: dict = {}
    return {
        (start, end): found for start in STATES for end, found in align(codes, start, STATES, False, tables).items()
    }


def code_of(role: str, text: str, repeated: bool) -> tuple[str, str]:
    """The row's code and its first fault: '', 'blank', 'duplicate' or 'truncated'."""
    last = text.rstrip(BLANKS)
    if not last:
        return FORCED, "blank"
    if repeated:
        return FORCED, "duplicate"
    initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
    return (initial, "") if last.endswith(ENDS) else (initial.upper(), "truncated")


def apply_audit(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of every turn that the edits leave."""
    due = ""
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit == "K" and not due and role.startswith("s"):
            due = "u"
        else:
            due = due or "u"
            if edit != "K":
                role = NAMES[due]
            due = "a" if due == "u" else "u"
        yield edit, role, text


class Repair:
    """Rows of one conversation in order, and what becomes of them."""

    def __init__(self, rows: list[tuple[int | None, str, str]], known: dict[str, tuple[int, str]]):
        self.rows = rows
        seen: set[tuple[str, str]] = set()
        codes, self.faults = [], {"blank": 0, "duplicate": 0, "truncated": 0, "": 0}
        for _, role, text in rows:
            code, fault = code_of(role, text, (role, text) in seen)
            seen.add((role, text))
            codes.append(code)
            self.faults[fault] += 1
        turns = {t for t, _, _ in rows if t is not None}
        self.gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        initials = [role[:1] for _, role, _ in rows]
        self.illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        key = "".join(codes)
        if key not in known:
            if len(known) >= REMEMBERED:
                known.clear()
            known[key] = align_whole(key)
        self.cost, self.audit = known[key]

    def turns(self) -> Iterator[tuple[str, str, str]]:
        return apply_audit(self.audit, ((role, text) for _, role, text in self.rows))


REPORT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _report_schema(df: DataFrame) -> StructType:
    return StructType([
        StructField("conv", df.schema["conv"].dataType), *[StructField(c, LongType()) for c in REPORT],
        StructField("audit", StringType()), StructField("repaired_sha256", StringType()),
    ])


def _turns_schema(df: DataFrame) -> StructType:
    return StructType([
        StructField("conv", df.schema["conv"].dataType), StructField("place", LongType()),
        StructField("edit", StringType()), StructField("role", StringType()), StructField("text", StringType()),
    ])


def _report(conv: object, repair: Repair) -> Iterator[tuple]:
    sha = hashlib.sha256()
    for i, (_, role, text) in enumerate(repair.turns()):
        sha.update(f"{chr(10) if i else ''}{role}:{text}".encode())
    faults = repair.faults
    yield (conv, repair.gaps, faults["blank"], faults["duplicate"], faults["truncated"], repair.illegal, repair.cost,
           repair.audit, sha.hexdigest())


def _repaired(conv: object, repair: Repair) -> Iterator[tuple]:
    for place, (edit, role, text) in enumerate(repair.turns()):
        yield conv, place, edit, role, text


def _by_conversation(rows: DataFrame, schema: StructType, make: Callable[[object, Repair], Iterator[tuple]]) -> DataFrame:
    """Whole conversations stream by in order; only one is held at a time."""
    arrow = to_arrow_schema(schema)

    def batch(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, type=f.type) for c, f in zip(zip(*out, strict=True), arrow, strict=True)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[int, str]] = {}
        current: list[tuple[int | None, str, str]] = []
        conv, begun, out, size = None, False, [], 0
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                columns = [c.to_pylist() for c in whole.slice(at, 1024).columns]
                for own, turn, role, text, times in zip(*columns, strict=True):
                    if not begun or own != conv:
                        if begun:
                            out.extend(make(conv, Repair(current, known)))
                        conv, begun, current = own, True, []
                        if len(out) >= 1024 or size >= 8_000_000:
                            yield batch(out)
                            out, size = [], 0
                    size += len(text) + 100
                    current.extend([(turn, role, text)] * times)
        if begun:
            out.extend(make(conv, Repair(current, known)))
        if out:
            yield batch(out)

    ordered = rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")
    return ordered.select("conv", "turn", "role", "text", "times").mapInArrow(run, schema)


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def split_long(rows: DataFrame, long_rows: int, long_chars: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of ordinary conversations, and those of long ones (None where there are none)."""
    sizes = rows.groupBy("conv").agg(F.sum("times").alias("n"), F.sum(F.length("text") * F.col("times")).alias("chars"))
    keys = stored(sizes.where((F.col("n") > long_rows) | (F.col("chars") > long_chars)).select(F.col("conv").alias("_conv")), "long")
    n = keys.count()
    if not n:
        return rows, None
    side = F.broadcast(keys) if n <= FEW_KEYS else keys
    match = _same(F.col("conv"), F.col("_conv"))
    return rows.join(side, match, "left_anti"), rows.join(side, match, "left_semi")


SEGMENT = StructType([
    StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("cost", LongType()),
    StructField("rank", IntegerType()), StructField("piece", StringType()),
])


class LongRows:
    """Long conversations by segments: rows in order, their codes, and the chosen audit of every segment."""

    def __init__(self, rows: DataFrame):
        kind = rows.schema["conv"].dataType
        each = rows.where("times > 0").withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("times")))).drop("times", "_n")
        # Equal rows may stand in any order; the salt lets range partitions cut between them.
        salted = each.withColumn("_salt", F.xxhash64(F.monotonically_increasing_id()))
        order = ["conv", "turn", "role", "text", "_salt"]
        self.rows = stored(salted.repartitionByRange(*order).sortWithinPartitions(*order).drop("_salt").withColumn(
            "pos", F.monotonically_increasing_id()), "turns")
        hashed = self.rows.select("conv", "pos", "turn", "role", "text", F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256).alias("hash"))
        firsts = hashed.groupBy("conv", "hash").agg(F.min("pos").alias("first"), F.count("*").alias("n")).where("n > 1").select(
            F.col("conv").alias("_conv"), F.col("hash").alias("_hash"), "first")
        marked = hashed.join(firsts, _same(F.col("conv"), F.col("_conv")) & (F.col("hash") == F.col("_hash")), "left")
        last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*+\z", 1)
        initial = F.substring("role", 1, 1)
        known = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
        blank, copy = last == "", F.coalesce(F.col("pos") > F.col("first"), F.lit(False))
        whole = last.isin(*ENDS)
        # Text comes to each segment as flags only: code, initial, fault.
        slim = marked.select(
            "conv", "pos", "turn", initial.alias("initial"),
            F.when(blank | copy, FORCED).when(whole, known).otherwise(F.upper(known)).alias("code"),
            F.when(blank, 1).when(copy, 2).when(whole, 0).otherwise(3).alias("fault"),
        )
        self.slim = stored(slim, "codes")
        segment = F.shiftright("pos", SEGMENT_BITS)
        one = F.sort_array(F.collect_list(F.struct("pos", "code", "initial")))
        segments = self.slim.groupBy("conv", segment.alias("segment")).agg(one.alias("rows")).select(
            "conv", "segment", F.array_join(F.transform("rows", lambda r: r["code"]), "").alias("codes"),
            F.transform("rows", lambda r: r["initial"]).alias("initials"),
        )
        fields = [StructField("conv", kind), StructField("segment", LongType())]

        def solve() -> Callable[..., Iterator[tuple]]:
            def fn(conv: object, segment: int, codes: str, initials: list[str]) -> Iterator[tuple]:
                illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
                found = align_segment(codes)
                for start in STATES:
                    pieces = sorted((audit, end, cost) for (s, end), (cost, audit) in found.items() if s == start)
                    for rank, (audit, end, cost) in enumerate(pieces):
                        yield conv, segment, start, end, cost, rank, audit, illegal, initials[0], initials[-1]
            return fn

        more = [StructField("illegal", LongType()), StructField("first", StringType()), StructField("last", StringType())]
        self.pieces = stored(map_rows(segments, StructType(fields + SEGMENT.fields + more), solve), "segments")
        matrices = self.pieces.groupBy("conv", "segment").agg(
            F.sort_array(F.collect_list(F.struct("start", "rank", "end", "cost"))).alias("ways"),
            F.first("illegal").alias("illegal"), F.first("first").alias("first"), F.first("last").alias("last"),
        ).repartition("conv").sortWithinPartitions("conv", "segment")
        chain = StructType(fields + [StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("cost", LongType()),
                                     StructField("illegal", LongType()), StructField("tail", StringType())])
        self.chain = stored(matrices.mapInArrow(_chained(to_arrow_schema(chain)), chain), "chain")
        a, b = self.pieces.alias("a"), self.chain.alias("b")
        on = _same(F.col("a.conv"), F.col("b.conv")) & (F.col("a.segment") == F.col("b.segment")) & (
            F.col("a.start") == F.col("b.start")) & (F.col("a.end") == F.col("b.end"))
        self.audits = a.join(b, on).select(
            F.col("a.conv").alias("conv"), F.col("a.segment").alias("segment"), F.col("a.start").alias("start"),
            F.concat("a.piece", "b.tail").alias("piece"))

    def turns(self) -> DataFrame:
        """conv, pos, nth, edit, role, text of every repaired turn; pos and nth give the order."""
        # One row per row or insertion: (conv, pos, nth, edit, role); the text is joined by place.
        places = self.slim.groupBy("conv", F.shiftright("pos", SEGMENT_BITS).alias("segment")).agg(
            F.sort_array(F.collect_list(F.struct("pos", "initial"))).alias("rows"))
        a, b = self.audits.alias("a"), places.alias("b")
        both = a.join(b, _same(F.col("a.conv"), F.col("b.conv")) & (F.col("a.segment") == F.col("b.segment"))).select(
            F.col("a.conv").alias("conv"), "start", "piece", "rows")

        def make() -> Callable[..., Iterator[tuple]]:
            def fn(conv: object, start: int, piece: str, rows: list[dict]) -> Iterator[tuple]:
                due = {START: "", OPENED: "u", ASSISTANT: "a", USER: "u"}[start]
                at, nth = 0, 0
                for edit in piece:
                    place = rows[min(at, len(rows) - 1)]
                    order = 2 * place["pos"] + (at == len(rows))
                    if edit == "D":
                        at, nth = at + 1, 0
                        continue
                    if edit == "K" and not due and place["initial"] == "s":
                        due, role = "u", None
                    else:
                        due = due or "u"
                        role = None if edit == "K" else NAMES[due]
                        due = "a" if due == "u" else "u"
                    if edit == "I":
                        yield conv, order, nth, edit, role, None
                        nth += 1
                    else:
                        yield conv, order, nth, edit, role, place["pos"]
                        at, nth = at + 1, 0
            return fn

        schema = StructType([
            StructField("conv", self.rows.schema["conv"].dataType), StructField("order", LongType()), StructField("nth", LongType()),
            StructField("edit", StringType()), StructField("name", StringType()), StructField("row", LongType()),
        ])
        edits = map_rows(both, schema, make)
        texts = self.rows.select(F.col("pos").alias("row"), "role", "text")
        return edits.join(texts, "row", "left").select(
            "conv", "order", "nth", "edit", F.coalesce("name", "role").alias("role"), F.coalesce("text", F.lit("")).alias("text"))

    def report(self) -> DataFrame:
        kinds = {"blank": 1, "duplicate": 2, "truncated": 3}
        faults = self.slim.groupBy("conv").agg(
            F.min("turn").alias("lo"), F.max("turn").alias("hi"),
            *[F.count_if(F.col("fault") == k).alias(c) for c, k in kinds.items()])
        distinct = self.slim.where("turn is not null").select("conv", "turn").distinct().groupBy("conv").agg(F.count("*").alias("turns"))
        costs = self.chain.groupBy("conv").agg(F.sum("cost").alias("cost"), F.sum("illegal").alias("illegal"))
        audits = self.audits.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("segment", "piece"))).alias("p")).select(
            "conv", F.array_join(F.transform("p", lambda x: x["piece"]), "").alias("audit"))
        lines = self.turns().repartition("conv").sortWithinPartitions("conv", "order", "nth").select("conv", "role", "text")
        schema = StructType([StructField("conv", self.rows.schema["conv"].dataType), StructField("repaired_sha256", StringType())])
        hashes = lines.mapInArrow(_hashed(to_arrow_schema(schema)), schema)
        out = faults.withColumnRenamed("conv", "_c")
        for side in (distinct, costs, audits, hashes):
            out = out.join(side, _same(F.col("_c"), F.col("conv")), "left").drop("conv")
        gaps = F.coalesce(F.col("hi") - F.col("lo") + 1 - F.col("turns"), F.lit(0)).cast("long")
        return out.select(
            F.col("_c").alias("conv"), gaps.alias("gaps"), *[F.col(c).cast("long").alias(c) for c in REPORT[1:]], "audit",
            F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


def _chained(arrow: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The cheapest chain through a conversation's segments; a segment is 16 numbers here, whatever its length."""

    def chain(conv: object, parts: list[tuple]) -> Iterator[tuple]:
        rest = np.array([TAIL[s][0] for s in STATES], dtype=np.int64)
        after = [rest]
        for _, ways, *_ in reversed(parts):
            new = np.full(4, NEVER, dtype=np.int64)
            for w in ways:
                new[w["start"]] = min(new[w["start"]], w["cost"] + rest[w["end"]])
            rest = new
            after.append(rest)
        after.reverse()
        state, before = START, ""
        for i, (segment, ways, illegal, first, last) in enumerate(parts):
            way = min((w for w in ways if w["start"] == state and w["cost"] + after[i + 1][w["end"]] == after[i][state]),
                      key=lambda w: w["rank"])
            end = i == len(parts) - 1
            extra, tail = TAIL[way["end"]] if end else (0, "")
            broken = int(i > 0 and before + first not in ("su", "ua", "au"))
            yield conv, segment, state, way["end"], way["cost"] + extra, illegal + broken, tail
            state, before = way["end"], last

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, parts = None, []

        def done() -> Iterator[pa.RecordBatch]:
            out = list(chain(conv, parts))
            for at in range(0, len(out), 10_000):
                columns = zip(*out[at:at + 10_000], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

        for batch in batches:
            for own, *part in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if parts and own != conv:
                    yield from done()
                    parts = []
                conv = own
                parts.append(tuple(part))
        if parts:
            yield from done()

    return run


def _hashed(arrow: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """SHA-256 of each conversation's lines as they stream by; a hash cannot be put together from parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, sha = None, None
        out: list[tuple] = []
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                for own, role, text in zip(*[c.to_pylist() for c in whole.slice(at, 256).columns], strict=True):
                    if sha is None or own != conv:
                        if sha is not None:
                            out.append((conv, sha.hexdigest()))
                        conv, sha = own, hashlib.sha256()
                    else:
                        sha.update(b"\n")
                    sha.update(f"{role}:{text}".encode())
        if sha is not None:
            out.append((conv, sha.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out, strict=True), arrow, strict=True)], schema=arrow)

    return run


def repair_report(rows: DataFrame, long_rows: int = LONG_ROWS, long_chars: int = LONG_CHARS) -> DataFrame:
    """One row per conversation of ``rows`` (conv, turn, role, text, times as ``damage`` gives them).

    Returns conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256. Rows stand by turn (NULL first),
    equal turns by role and text. Conversations whose rows all have times 0, and so a table of them,
    get zeros, an empty audit and the hash of the empty string; an empty table gives no rows; a NULL id is a conversation of
    its own; repeated rows are duplicates; other columns are not read.
    """
    ordinary, long = split_long(rows, long_rows, long_chars)
    out = _by_conversation(ordinary, _report_schema(rows), _report)
    return out if long is None else out.unionByName(LongRows(long).report())


def repair_turns(rows: DataFrame, long_rows: int = LONG_ROWS, long_chars: int = LONG_CHARS) -> DataFrame:
    """The repaired conversations: conv, place, edit (K, R or I), role, text; deleted turns have no row."""
    ordinary, long = split_long(rows, long_rows, long_chars)
    out = _by_conversation(ordinary, _turns_schema(rows), _repaired)
    if long is None:
        return out
    # Places within a long conversation: numbers within slices of rows, added up over slices.
    turns = LongRows(long).turns().withColumn("slice", F.shiftright("order", SEGMENT_BITS + 1))
    sizes = turns.groupBy("conv", "slice").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select(F.col("conv").alias("_conv"), F.col("slice").alias("_slice"), F.coalesce(before, F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("conv", "slice").orderBy("order", "nth"))
    placed = turns.withColumn("_n", inside).join(
        starts, _same(F.col("conv"), F.col("_conv")) & (F.col("slice") == F.col("_slice")))
    return out.unionByName(placed.select(
        "conv", (F.col("before") + F.col("_n") - 1).cast("long").alias("place"), "edit", "role", "text"))
