"""Conversation structure repair: the cheapest edits that make the roles of a conversation ``(s?(ua)+)?``.

Every turn is one symbol of role and fault. Re-Pair gives frequent neighbours a rule of their own, in Spark rounds over the
distinct sequences, so all conversations share one grammar. A symbol is a min-plus matrix over the four states
of the role pattern, each entry a cost and an audit: a rope, which is two ropes of the halves or a few letters. A rule's matrix is the
product of its halves, evaluated bottom-up once; a conversation is the product of what its grammar leaves of it.
Equal costs go to the audit that is least in ASCII. Audits of equal cost over the same turns are never prefixes of each other, because
every insertion costs, so the least of a product is the product of least ones.

The turns are range-partitioned in their order and cut into slices, so a conversation with a third of all turns covers many tasks;
only its slices' matrices, one for thousands of turns, are chained one after the other, and its texts hashed, because SHA-256 is sequential.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtide.llm.storage import stored

SLICE_BITS = 12
#: Rounds of pair counting, and rules made in one. They shorten sequences and never change a result.
ROUNDS = 6
RULES_A_ROUND = 16
KEEP, REROLE, DELETE, INSERT, UNTRUNCATED = 0, 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTED = (START, ASSISTANT)
_BLANKS = " \t\n\v\f\r"
_STATE_OF = {"s": SYSTEM, "u": USER, "a": ASSISTANT}


class Rope:
    """A text as a leaf or as two ropes; equal parts are shared."""

    __slots__ = ("left", "right", "text", "length")

    def __init__(self, text: str | None = None, left: Rope | None = None, right: Rope | None = None):
        self.text, self.left, self.right = text, left, right
        self.length = len(text) if text is not None else left.length + right.length

    def leaves(self) -> Iterator[str]:
        stack = [self]
        while stack:
            node = stack.pop()
            if node.text is None:
                stack += (node.right, node.left)
            else:
                yield node.text

    def __str__(self) -> str:
        return "".join(self.leaves())


def joined(left: Rope, right: Rope) -> Rope:
    return right if not left.length else left if not right.length else Rope(None, left, right)


def less(x: Rope, y: Rope) -> bool:
    """Whether x is before y; nodes that both share are passed over."""
    a, b = [x], [y]
    while a and b:
        p, q = a.pop(), b.pop()
        if p is q:
            continue
        if p.text is not None and q.text is not None:
            n = min(p.length, q.length)
            if p.text[:n] != q.text[:n]:
                return p.text < q.text
            if p.length > n:
                a.append(Rope(p.text[n:]))
            if q.length > n:
                b.append(Rope(q.text[n:]))
        elif q.text is not None or (p.text is None and p.length >= q.length):
            a += (p.right, p.left)
            b.append(q)
        else:
            a.append(p)
            b += (q.right, q.left)
    return any(r.length for r in b) and not any(r.length for r in a)


Entry = tuple[int, Rope] | None
Matrix = list[list[Entry]]


def _better(new: Entry, old: Entry) -> Entry:
    if old is None or new is not None and (new[0] < old[0] or new[0] == old[0] and less(new[1], old[1])):
        return new
    return old


def times(rows: Matrix, other: Matrix) -> Matrix:
    """Min-plus product; among equal costs the least audit."""
    out: Matrix = []
    for row in rows:
        made: list[Entry] = [None] * 4
        for i, first in enumerate(row):
            if first is None:
                continue
            for j, second in enumerate(other[i]):
                if second is None:
                    continue
                cost, old = first[0] + second[0], made[j]
                if old is None or cost <= old[0]:
                    made[j] = _better((cost, joined(first[1], second[1])), old)
        out.append(made)
    return out


def _expects(state: int) -> int:
    return ASSISTANT if state == USER else USER


def _insertions() -> Matrix:
    """No insertion, or the fewest that lead from one state to another."""
    out: Matrix = [[None] * 4 for _ in range(4)]
    for i in range(4):
        state, cost, text = i, 0, ""
        while out[i][state] is None:
            out[i][state] = (cost, Rope(text))
            state, cost, text = _expects(state), cost + INSERT, text + "I"
    return out


INSERTIONS = _insertions()


def symbol_matrix(symbol: str) -> Matrix:
    """One turn and the insertions behind it: ``x`` must go, capitals are truncated, other letters are roles."""
    out: Matrix = [[None] * 4 for _ in range(4)]
    for i in range(4):
        out[i][i] = (DELETE, Rope("D"))
        if symbol == "x":
            continue
        extra = UNTRUNCATED if symbol.isupper() else 0
        target = _expects(i)
        out[i][target] = _better((REROLE + extra, Rope("R")), out[i][target])
        own = _STATE_OF.get(symbol.lower())
        if own == target or (own == SYSTEM and i == START):
            out[i][own] = _better((KEEP + extra, Rope("K")), out[i][own])
    return times(out, INSERTIONS)


Rules = list[tuple[str, str]]


def shortened(sequence: str, rules: Rules) -> str:
    for pair, name in rules:
        sequence = sequence.replace(pair, name)
    return sequence


def pair_counts(sequence: str) -> Counter[str]:
    """How often each pair of neighbours can be replaced."""
    counts = Counter(map("".join, zip(sequence, sequence[1:], strict=False)))
    for pair in [p for p in counts if p[0] == p[1]]:
        counts[pair] = sequence.count(pair)
    return counts


def learn_rules(forms: DataFrame, rounds: int = ROUNDS, a_round: int = RULES_A_ROUND) -> Rules:
    """Re-Pair over ``forms(seq)``: every round names the most frequent pairs, as far as they share no symbol.

    Only the counts of pairs leave the tasks, and of these the first few the cluster.
    """
    rules: Rules = []
    for _ in range(rounds):

        def count(batches: Iterator[pa.RecordBatch], rules: Rules = tuple(rules)) -> Iterator[pa.RecordBatch]:
            total: Counter[str] = Counter()
            for batch in batches:
                for sequence in batch.column(0).to_pylist():
                    total.update(pair_counts(shortened(sequence, rules)))
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["pair", "n"])

        pairs = forms.select("seq").mapInArrow(count, "pair string, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
        used: set[str] = set()
        for row in pairs.where("n > 1").orderBy(F.desc("n"), "pair").limit(a_round).collect():
            if not used & set(row.pair):
                used |= set(row.pair)
                rules.append((row.pair, chr(0xE000 + len(rules))))
        if not used:
            break
    return rules


def rule_matrices(rules: Rules) -> dict[str, Matrix]:
    """Matrices of the symbols, then of the rules, each from its two halves."""
    made = {s: symbol_matrix(s) for s in "xsuaoSUAO"}
    for pair, name in rules:
        made[name] = times(made[pair[0]], made[pair[1]])
    return made


def evaluate(sequence: str, rules: Rules, matrices: dict[str, Matrix], rows: Matrix) -> Matrix:
    for symbol in shortened(sequence, rules):
        rows = times(rows, matrices[symbol])
    return rows


def best_end(row: list[Entry]) -> tuple[int, int]:
    """The accepted state with the best entry, and its cost."""
    best, at = None, START
    for state in ACCEPTED:
        better = _better(row[state], best)
        if better is not best:
            best, at = better, state
    return at, best[0]


def _identity() -> Matrix:
    return [[(0, Rope("")) if i == j else None for j in range(4)] for i in range(4)]


def _solved(rules: Rules):
    """(seq, audit) of sequences that are a whole conversation, and (seq, cells) of those that are a slice of one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrices = rule_matrices(rules)
        cell = pa.list_(pa.struct([("cost", pa.int64()), ("audit", pa.string())]))
        for batch in batches:
            audits, cells = [], []
            for sequence, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if part:
                    made = evaluate(sequence, rules, matrices, _identity())
                    cells.append([e and {"cost": e[0], "audit": str(e[1])} for row in made for e in row])
                    audits.append(None)
                else:
                    row = evaluate(sequence, rules, matrices, [INSERTIONS[START]])[0]
                    audits.append(str(row[best_end(row)[0]][1]))
                    cells.append(None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(audits, pa.string()), pa.array(cells, cell)], ["seq", "audit", "cells"])

    return run


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The audit of every slice, from the matrices of a conversation's slices in order: (conv_id, slice, audit)."""
    now, slices, row, steps = None, [], [], []

    def finish() -> pa.RecordBatch:
        state, parts = best_end(row)[0], []
        for back in reversed(steps):
            state, text = back[state]
            parts.append(text)
        parts.reverse()
        return pa.RecordBatch.from_arrays([ids.slice(0, 0) if not slices else pa.array([now] * len(slices), ids.type),
                                           pa.array(slices, pa.int64()), pa.array(parts, pa.string())], ["conv_id", "slice", "audit"])

    for batch in batches:
        ids = batch.column(0)
        for conv, at, cells in zip(ids.to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if not slices or conv != now:
                if slices:
                    yield finish()
                now, slices, steps, row = conv, [], [], INSERTIONS[START]
            before, row, back = row, [None] * 4, [None] * 4
            for i, first in enumerate(before):
                for j in range(4):
                    if first is None or cells[4 * i + j] is None:
                        continue
                    cost, text = cells[4 * i + j]["cost"], cells[4 * i + j]["audit"]
                    entry = (first[0] + cost, joined(first[1], Rope(text)))
                    if _better(entry, row[j]) is not row[j]:
                        # insertions before the first turn belong to the first slice
                        row[j], back[j] = entry, (i, text if slices else str(first[1]) + text)
            slices.append(at)
            steps.append(back)
    if slices:
        yield finish()


class _Walk:
    """One conversation's turns under its audit, turn by turn."""

    def __init__(self, conv, keep_rows: bool):
        self.conv, self.state, self.place, self.sha = conv, START, 0, hashlib.sha256()
        self.rows: list[tuple] | None = [] if keep_rows else None
        self.faults = Counter()
        self.low = self.high = self.last = self.initial = None
        self.distinct = self.cost = 0
        self.audits: list[str] = []
        self.seq = self.audit = ""
        self.i = self.k = 0

    def _put(self, role: str, text: str, edit: str, turn) -> None:
        self.sha.update((("\n" if self.place else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        self.place += 1
        if self.rows is not None:
            self.rows.append((self.conv, self.place, edit, role, text, turn))

    def _made(self) -> str:
        self.state = _expects(self.state)
        return "user" if self.state == USER else "assistant"

    def insertions(self) -> None:
        while self.i < len(self.audit) and self.audit[self.i] == "I":
            self.cost += INSERT
            self._put(self._made(), "", "I", None)
            self.i += 1

    def begin(self, seq: str, audit: str) -> None:
        self.insertions()
        self.seq, self.audit, self.i, self.k = seq, audit, 0, 0
        self.audits.append(audit)

    def turn(self, turn, role: str, text: str | None, n: int) -> None:
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.distinct += turn != self.last
            self.high = self.last = turn
        initial = role[:1]
        self.faults["illegal"] += n - 1 + (self.initial is not None and self.initial + initial not in ("su", "ua", "au"))
        self.initial = initial
        for _ in range(n):
            symbol = self.seq[self.k]
            self.k += 1
            self.insertions()
            edit = self.audit[self.i]
            self.i += 1
            if symbol == "x":
                self.faults["blank" if text is None else "duplicate"] += 1
            elif symbol.isupper():
                self.faults["truncated"] += 1
            if edit == "D":
                self.cost += DELETE
                continue
            self.cost += (REROLE if edit == "R" else KEEP) + (UNTRUNCATED if symbol.isupper() else 0)
            if edit == "R":
                role = self._made()
            else:
                self.state = _STATE_OF[symbol.lower()]
            self._put(role, text, edit, turn)

    def report(self) -> tuple:
        self.insertions()
        gaps = 0 if self.low is None else int(self.high - self.low + 1 - self.distinct)
        counts = [self.faults[c] for c in ("blank", "duplicate", "truncated", "illegal")]
        return (self.conv, gaps, *counts, self.cost, "".join(self.audits), self.sha.hexdigest())


def _walked(keep_rows: bool, schema: pa.Schema):
    """Turns and audits in order, as reports or as repaired rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk, out = None, []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) if out else [[] for _ in schema]
            made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
            out.clear()
            return made

        def close() -> None:
            found = walk.report()
            out.extend([found] if walk.rows is None else walk.rows)

        for batch in batches:
            for conv, kind, turn, role, text, n, audit in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if walk is None or conv != walk.conv:
                    if walk is not None:
                        close()
                    walk = _Walk(conv, keep_rows)
                if kind == 0:
                    walk.begin(text, audit)
                else:
                    walk.turn(turn, role, text, n)
                if walk.rows:
                    out.extend(walk.rows)
                    walk.rows.clear()
                if len(out) >= 4096:
                    yield flush()
        if walk is not None:
            close()
        yield flush()

    return run


def _blank_free(text: Column) -> Column:
    return F.rtrim(text, F.lit(_BLANKS))


def _symbol() -> Column:
    initial = F.substring("role", 1, 1)
    role = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    ended = F.substring(_blank_free(F.col("text")), -1, 1).isin(".", "!", "?")
    return F.when(F.col("text").isNull(), "x").when(ended, role).otherwise(F.upper(role))


def _planned(turns: DataFrame, slice_bits: int) -> tuple[DataFrame, DataFrame]:
    """The turns in order, equal ones folded, and the audit of every slice."""
    given = turns.select(
        "conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    )
    folded = given.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").cast("int").alias("n"))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role")]
    ordered = folded.repartitionByRange(*order, F.substring("text", 1, 64)).sortWithinPartitions(*order, "text")
    ordered = ordered.withColumn("pos", F.monotonically_increasing_id())
    # a blank text needs no more than that
    ordered = stored(ordered.withColumn("text", F.when(_blank_free(F.col("text")) != "", F.col("text"))))
    ordered = ordered.withColumn("slice", F.shiftright("pos", slice_bits))

    marked = ordered.select("conv_id", "slice", "pos", "n", "role", F.sha2("text", 256).alias("digest"), _symbol().alias("symbol"))
    same = ["conv_id", "role", "digest"]
    again = marked.where("digest is not null").groupBy(*same).agg(F.min("pos").alias("first"), F.count("*").alias("times"))
    again = again.where("times > 1").select(*[F.col(c).alias(f"_{c}") for c in same], "first")
    on = marked["conv_id"].eqNullSafe(again["_conv_id"]) & (marked["role"] == again["_role"]) & (marked["digest"] == again["_digest"])
    later = F.col("first").isNotNull() & (F.col("pos") != F.col("first"))
    symbols = F.concat(F.when(later, "x").otherwise(F.col("symbol")), F.repeat(F.lit("x"), F.col("n") - 1))
    lists = marked.join(again, on, "left").select("conv_id", "slice", F.struct("pos", symbols.alias("s")).alias("e"))
    lists = lists.groupBy("conv_id", "slice").agg(F.array_sort(F.collect_list("e")).alias("e"))
    seqs = stored(lists.select("conv_id", "slice", F.array_join(F.col("e.s"), "").alias("seq")))

    many = seqs.groupBy("conv_id").agg(F.count("*").alias("slices")).where("slices > 1").select(F.col("conv_id").alias("_conv"))
    seqs = seqs.join(many.withColumn("part", F.lit(True)), seqs["conv_id"].eqNullSafe(many["_conv"]), "left").drop("_conv")
    seqs = stored(seqs.withColumn("part", F.coalesce("part", F.lit(False))))
    forms = stored(seqs.select("seq", "part").distinct())
    rules = learn_rules(forms)
    solved = stored(forms.mapInArrow(_solved(rules), "seq string, audit string, cells array<struct<cost: bigint, audit: string>>"))
    whole = seqs.where("not part").join(solved.where("cells is null").select("seq", "audit"), "seq")
    parts = seqs.where("part").join(solved.where("cells is not null").select("seq", "cells"), "seq")
    kind = turns.schema["conv_id"].dataType.simpleString()
    chain = parts.select("conv_id", "slice", "cells").repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "slice")
    chain = chain.mapInArrow(_chained, f"conv_id {kind}, slice bigint, audit string").toDF("_conv", "_slice", "audit")
    chosen = seqs.where("part").join(chain, seqs["conv_id"].eqNullSafe(chain["_conv"]) & (seqs["slice"] == chain["_slice"]))
    fields = ["conv_id", "slice", "seq", "audit"]
    return ordered, whole.select(*fields).union(chosen.select(*fields))


def _walk_over(turns: DataFrame, keep_rows: bool, slice_bits: int) -> DataFrame:
    ordered, audits = _planned(turns, slice_bits)
    types = {c: turns.schema[c].dataType.simpleString() for c in ("conv_id", "turn")}
    rows = ordered.select("conv_id", "pos", F.lit(1).alias("kind"), "turn", "role", "text", "n", F.lit(None).cast("string").alias("audit"))
    heads = audits.select("conv_id", F.shiftleft("slice", slice_bits).alias("pos"), F.lit(0).alias("kind"), F.lit(None).cast(types["turn"]).alias("turn"),
                          F.lit("").alias("role"), F.col("seq").alias("text"), F.lit(0).alias("n"), "audit")
    both = rows.unionByName(heads).repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "pos", "kind")
    both = both.select("conv_id", "kind", "turn", "role", "text", "n", "audit")
    if keep_rows:
        schema = f"conv_id {types['conv_id']}, place bigint, edit string, role string, text string, turn {types['turn']}"
    else:
        counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
        schema = f"conv_id {types['conv_id']}, {', '.join(f'{c} bigint' for c in counts)}, audit string, repaired_sha256 string"
    from pyspark.sql.pandas.types import to_arrow_schema

    return both.mapInArrow(_walked(keep_rows, to_arrow_schema(_parsed(turns, schema))), schema)


def _parsed(like: DataFrame, schema: str):
    return like.sparkSession.createDataFrame([], schema).schema


def repaired_turns(turns: DataFrame, slice_bits: int = SLICE_BITS) -> DataFrame:
    """The repaired conversations: (conv_id, place, edit, role, text, turn), ``place`` from 1; an inserted turn has no ``turn``."""
    return _walk_over(turns, True, slice_bits)


def repair_report(turns: DataFrame, ids: DataFrame | None = None, slice_bits: int = SLICE_BITS) -> DataFrame:
    """Faults, cost, audit and the SHA-256 of the repaired text, for every conversation of ``turns(conv_id, turn, role, text)``.

    A conversation's turns are taken by turn (nulls first), then role, then text. Each first fault counts: blank, duplicate (role and text
    seen before), truncated (no ``.!?`` at the end). ``gaps`` are missing numbers between the smallest and the largest turn; ``illegal``
    are neighbours whose roles do not follow each other. ``ids(conv_id)`` names conversations that are returned even
    without turns: zeros, an empty audit, the hash of nothing.

    Nulls: a null role or text is one blank, null conv_ids are one conversation, null turns take no part in gaps. Equal rows are duplicates
    of the first. An empty table without ``ids`` gives no rows. Further columns are not read, whatever their names.
    """
    found = _walk_over(turns, False, slice_bits)
    if ids is None:
        return found
    wanted = ids.select(F.col("conv_id").alias("_id")).distinct()
    joined_ = wanted.join(found, wanted["_id"].eqNullSafe(found["conv_id"]), "left").drop("conv_id").withColumnRenamed("_id", "conv_id")
    zeros = dict.fromkeys(("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), 0)
    return joined_.fillna({**zeros, "audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}).select(*found.columns)


def damaged(turns: DataFrame) -> DataFrame:
    """Damage by rule: of 20 turns one is dropped, emptied, stripped of its ends of sentences, repeated, or given to the user.

    The rule is the CRC-32 of ``conv_id:turn``. Nulls are one blank.
    """
    blank = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")])
    role, text = (F.coalesce(F.col(c).cast("string"), blank) for c in ("role", "text"))
    rule = F.col("_rule")
    made = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(key.cast("binary")) % 20).alias("_rule"))
    made = made.where(rule != 0)
    cut = F.when(rule == 1, "").when(rule == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    made = made.withColumns({"text": cut, "role": F.when(rule == 4, "user").otherwise(F.col("role"))})
    return made.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.when(rule == 3, 2).otherwise(1)))).drop("_copy", "_rule")
