"""Conversation repair: generalised LR parsing over the role grammar with weighted edits."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxmill.llm.common import quoted, spread_join, stored

#: A conversation: nothing, or an optional system turn and then pairs of a user's and an assistant's.
ROLE_GRAMMAR: dict[str, tuple[str, ...]] = {"C": ("", "P", "sP"), "P": ("T", "PT"), "T": ("ua",)}
#: Roles that an edit can give or insert, by their initials.
ROLES = {"u": "user", "a": "assistant"}
#: What the edits cost; a row whose text is cut off costs TRUNCATED more unless it is deleted.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: A conversation longer than this comes in several parts: rows, and about so many bytes of text.
PART_ROWS = 2000
PART_BYTES = 4 << 20
#: A grammar must reach only so many different stacks.
MOST_STACKS = 200

BLANKS = " \t\n\x0b\x0c\r"
END = "$"
OK, BLANK, DUPLICATE, CUT = 0, 1, 2, 3


class ParseTable:
    """Simple LR actions of a grammar: for (state, token), the states to shift to and the
    productions to reduce; several where the grammar leaves a choice."""

    def __init__(self, grammar: dict[str, tuple[str, ...]]):
        start = next(iter(grammar))
        rules = [("", start)] + [(head, body) for head, bodies in grammar.items() for body in bodies]
        follow = self._follow(grammar, start)

        def closed(items):
            items, todo = set(items), list(items)
            while todo:
                rule, dot = todo.pop()
                body = rules[rule][1]
                if dot < len(body) and body[dot] in grammar:
                    for i, (head, _) in enumerate(rules):
                        if head == body[dot] and (i, 0) not in items:
                            items.add((i, 0))
                            todo.append((i, 0))
            return frozenset(items)

        states = [closed({(0, 0)})]
        self.goto: dict[tuple[int, str], int] = {}
        for at, items in enumerate(states):  # grows while it is read
            for symbol in sorted({rules[r][1][d] for r, d in items if d < len(rules[r][1])}):
                target = closed({(r, d + 1) for r, d in items if rules[r][1][d:d + 1] == symbol})
                if target not in states:
                    states.append(target)
                self.goto[at, symbol] = states.index(target)
        self.reductions: dict[tuple[int, str], list[tuple[str, int]]] = defaultdict(list)
        self.accepting = set()
        for at, items in enumerate(states):
            for r, d in sorted(items):
                head, body = rules[r]
                if d == len(body) and r:
                    for token in follow[head]:
                        self.reductions[at, token].append((head, len(body)))
                elif d == len(body):
                    self.accepting.add(at)

    @staticmethod
    def _follow(grammar, start):
        empty = {h for h, bodies in grammar.items() if "" in bodies}
        first = {h: set() for h in grammar}
        follow = {h: set() for h in grammar}
        follow[start].add(END)
        for _ in range(2 * len(grammar) + 2):
            for head, bodies in grammar.items():
                for body in bodies:
                    if all(s in empty for s in body):
                        empty.add(head)
                    for symbol in body:
                        first[head] |= first.get(symbol, {symbol})
                        if symbol not in empty:
                            break
                    after = set(follow[head])
                    for symbol in reversed(body):
                        if symbol in grammar:
                            follow[symbol] |= after
                            after = first[symbol] | (after if symbol in empty else set())
                        else:
                            after = {symbol}
        return follow


class StackGraph:
    """Stacks of parser states as one graph: a node is a state on top of another node, and equal
    stacks are one node. What a token does to a node is worked out once."""

    def __init__(self, grammar: dict[str, tuple[str, ...]], insertable: str):
        self.table = ParseTable(grammar)
        self.nodes: list[tuple[int, int]] = [(-1, 0)]  # (node below, state)
        self.known = {(-1, 0): 0}
        self.moves: dict[tuple[int, str], tuple[int, ...]] = {}
        self.insertable = insertable
        tokens = sorted({s for bodies in grammar.values() for b in bodies for s in b if s not in grammar})
        for node in _growing(self.nodes):
            for token in tokens:
                self.shift(node, token)
        #: Stacks that are left after a token; the others only stand between two tokens.
        self.live = sorted({0, *(n for found in self.moves.values() for n in found)})
        #: Per node, the nodes that insertions lead to, with the inserted roles: the fewest, then the first.
        self.inserts = [self._inserts(n) for n in range(len(self.nodes))]
        #: Per node, the cheapest insertions after which the input may end.
        self.endings = [min(((len(t), t) for n, t in self.inserts[node].items() if self._accepts(n)),
                            default=(0, None))[1] for node in range(len(self.nodes))]

    def _push(self, below: int, state: int) -> int:
        if (below, state) not in self.known:
            if len(self.nodes) >= MOST_STACKS:
                raise ValueError("the grammar has too many stacks; write its repetitions left-recursively")
            self.known[below, state] = len(self.nodes)
            self.nodes.append((below, state))
        return self.known[below, state]

    def _reduced(self, node: int, token: str) -> list[int]:
        """The node and all that reductions before ``token`` make of it."""
        found = [node]
        for at in found:  # grows while it is read
            for head, width in self.table.reductions.get((self.nodes[at][1], token), ()):
                below = at
                for _ in range(width):
                    below = self.nodes[below][0]
                state = self.table.goto.get((self.nodes[below][1], head))
                if state is not None and (top := self._push(below, state)) not in found:
                    found.append(top)
        return found

    def shift(self, node: int, token: str) -> tuple[int, ...]:
        if (node, token) not in self.moves:
            states = ((n, self.table.goto.get((self.nodes[n][1], token))) for n in self._reduced(node, token))
            self.moves[node, token] = tuple(sorted({self._push(n, s) for n, s in states if s is not None}))
        return self.moves[node, token]

    def _inserts(self, node: int) -> dict[int, str]:
        found, todo = {node: ""}, [node]
        for at in todo:  # grows while it is read: nearest first
            for token in self.insertable:
                for n in self.shift(at, token):
                    if n not in found:
                        found[n] = found[at] + token
                        todo.append(n)
        return found

    def _accepts(self, node: int) -> bool:
        return any(self.nodes[n][1] in self.table.accepting for n in self._reduced(node, END))


def _growing(items: list) -> Iterator[int]:
    at = 0
    while at < len(items):
        yield at
        at += 1


#: The cheapest way to a stack: cost, audit, and the role of each edit ("-" for a deletion).
Way = tuple[int, str, str]


@dataclass
class Repairer:
    """The edits of rows, from any stack to any stack."""

    graph: StackGraph
    steps: dict = field(default_factory=dict)

    def _options(self, node: int, initial: str, fault: int) -> list[tuple[int, int, str, str]]:
        """(next node, cost, audit, roles) of one row; insertions come before its own edit."""
        key = node, initial, fault
        if key not in self.steps:
            # Deleting first and inserting later costs the same and reads smaller, so never the reverse.
            found = [(node, DELETE, "D", "-")]
            if fault not in (BLANK, DUPLICATE):
                extra = TRUNCATED if fault == CUT else 0
                for at, roles in self.graph.inserts[node].items():
                    cost, audit = INSERT * len(roles), "I" * len(roles)
                    found += [(n, cost + KEEP + extra, audit + "K", roles + initial)
                              for n in self.graph.moves.get((at, initial), ())]
                    found += [(n, cost + REROLE + extra, audit + "R", roles + role)
                              for role in self.graph.insertable for n in self.graph.moves.get((at, role), ())]
            self.steps[key] = found
        return self.steps[key]

    def advance(self, ways: dict[int, Way], initial: str, fault: int, copies: int) -> dict[int, Way]:
        """One row and its equal copies, which are all deleted. Ways to equal stacks are merged by
        the smaller (cost, audit)."""
        after: dict[int, Way] = {}
        for node, (cost, audit, roles) in ways.items():
            for target, c, a, r in self._options(node, initial, fault):
                way = (cost + c, audit + a, roles + r)
                if target not in after or way < after[target]:
                    after[target] = way
        if copies > 1:
            more = copies - 1
            after = {n: (c + DELETE * more, a + "D" * more, r + "-" * more) for n, (c, a, r) in after.items()}
        return after

    def whole(self, rows: list[tuple[str, int, int]], start: dict[int, Way]) -> dict[int, Way]:
        for initial, fault, copies in rows:
            start = self.advance(start, initial, fault, copies)
        return start

    def finished(self, ways: dict[int, Way]) -> Way:
        return min((cost + INSERT * len(end), audit + "I" * len(end), roles + end)
                   for node, (cost, audit, roles) in ways.items()
                   if (end := self.graph.endings[node]) is not None)


def _repairer() -> Repairer:
    return Repairer(StackGraph(ROLE_GRAMMAR, "".join(ROLES)))


def _messages(rows: list[dict], audit: str, roles: str) -> list[dict]:
    """The turns that an audit leaves of the rows (each with its copies), in order."""
    out = []
    each = (row for row in rows for _ in range(row["copies"]))
    for edit, role in zip(audit, roles, strict=True):
        row = None if edit == "I" else next(each)
        if edit == "K":
            out.append({"role": row["role"], "text": row["text"]})
        elif edit == "R":
            out.append({"role": ROLES[role], "text": row["text"]})
        elif edit == "I":
            out.append({"role": ROLES[role], "text": ""})
    return out


_TURN = pa.struct([("role", pa.string()), ("text", pa.string())])
_ROW = pa.struct([("role", pa.string()), ("text", pa.string()), ("fault", pa.int32()), ("copies", pa.int64())])
_WAY = pa.struct([("from", pa.int32()), ("to", pa.int32()), ("cost", pa.int64()), ("audit", pa.string()),
                  ("roles", pa.string())])
_FACTS = [("rows", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
          ("illegal", pa.int64())]
_PART = pa.schema([
    ("_conv", pa.string()), ("_task", pa.int32()), ("_part", pa.int32()), ("open", pa.bool_()), *_FACTS,
    ("first_role", pa.string()), ("last_role", pa.string()), ("cost", pa.int64()), ("audit", pa.string()),
    ("messages", pa.list_(_TURN)), ("held", pa.list_(_ROW)), ("ways", pa.list_(_WAY))])
_PART_DDL = (
    "_conv string, _task int, _part int, open boolean, rows long, blank long, duplicate long, truncated long, "
    "illegal long, first_role string, last_role string, cost long, audit string, "
    "messages array<struct<role:string,text:string>>, "
    "held array<struct<role:string,text:string,fault:int,copies:long>>, "
    "ways array<struct<from:int,to:int,cost:long,audit:string,roles:string>>")
_LEGAL = ("su", "ua", "au")


def _initial(role: str) -> str:
    return role[:1]


def _part(repairer: Repairer, conv: str, number: int, rows: list[dict], whole: bool) -> dict:
    """What is known of consecutive rows of a conversation. Of a whole conversation that is its
    repair; of a part, the cheapest ways between all stacks, with the rows to apply them to."""
    classes = [(_initial(r["role"]), r["fault"], r["copies"]) for r in rows]
    counts = [0, 0, 0, 0]
    illegal = 0
    for i, (initial, fault, copies) in enumerate(classes):
        counts[fault] += 1
        # Copies follow their row: blank ones are blank, others repeat what was seen.
        counts[BLANK if fault == BLANK else DUPLICATE] += copies - 1
        illegal += (copies - 1) * (initial + initial not in _LEGAL)
        if i:
            illegal += classes[i - 1][0] + initial not in _LEGAL
    out = {
        "_conv": conv, "_task": TaskContext.get().partitionId(), "_part": number, "open": not whole,
        "rows": sum(c for *_, c in classes), "blank": counts[BLANK], "duplicate": counts[DUPLICATE],
        "truncated": counts[CUT], "illegal": illegal, "first_role": classes[0][0], "last_role": classes[-1][0],
        "cost": None, "audit": None, "messages": None, "held": None, "ways": None}
    if whole:
        cost, audit, roles = repairer.finished(repairer.whole(classes, {0: (0, "", "")}))
        return out | {"cost": cost, "audit": audit, "messages": _messages(rows, audit, roles)}
    ways = [{"from": start, "to": end, "cost": c, "audit": a, "roles": r}
            for start in repairer.graph.live
            for end, (c, a, r) in repairer.whole(classes, {start: (0, "", "")}).items()]
    return out | {"held": rows, "ways": ways}


def _parts(part_rows: int, part_bytes: int):
    """Task over rows in order: a record for each conversation, or for each part of a long one and of
    the first and last of the task, which may go on elsewhere."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repairer = _repairer()
        ready: list[dict] = []
        conv, rows, size, number, first = None, [], 0, 0, True

        def close(last: bool) -> None:
            nonlocal rows, size, number, first
            if rows:
                ready.append(_part(repairer, conv, number, rows, whole=not (first or last or number)))
            rows, size, number, first = [], 0, 0, False

        for batch in batches:
            for row in batch.to_pylist():
                if row["_conv"] != conv:
                    if conv is not None:
                        close(last=False)
                    conv = row["_conv"]
                elif len(rows) >= part_rows or size >= part_bytes:
                    ready.append(_part(repairer, conv, number, rows, whole=False))
                    rows, size, number = [], 0, number + 1
                rows.append({k: row[k] for k in ("role", "text", "fault", "copies")})
                size += len(row["text"])
            if ready:
                yield pa.RecordBatch.from_pylist(ready, _PART)
                ready = []
        if conv is not None:
            close(last=True)
            yield pa.RecordBatch.from_pylist(ready, _PART)

    return run


def _chosen(table: pa.Table) -> pa.Table:
    """For the parts of one conversation in order, the stacks that its cheapest repair goes through.

    The audits between all stacks of a part have as many edits of rows each and end in one, so none
    is the beginning of another: their ranks stand for them, and ways through many parts compare by
    the ranks of the first part in which they differ.
    """
    graph = _repairer().graph
    parts = sorted(table.to_pylist(), key=lambda p: (p["_task"], p["_part"]))
    ways: dict[int, tuple[int, int]] = {0: (0, 0)}  # node: (cost, place of its audit so far)
    back: list[dict[int, int]] = []
    for part in parts:
        best: dict[int, tuple] = {}
        for step in part["ways"]:
            if step["from"] in ways:
                cost, place = ways[step["from"]]
                found = (cost + step["cost"], (place, step["rank"]), step["from"])
                if step["to"] not in best or found < best[step["to"]]:
                    best[step["to"]] = found
        places = {p: i for i, p in enumerate(sorted({p for _, p, _ in best.values()}))}
        ways = {to: (cost, places[p]) for to, (cost, p, _) in best.items()}
        back.append({to: start for to, (_, _, start) in best.items()})
    ends = [(cost + INSERT * len(end), place, "I" * len(end), end, node)
            for node, (cost, place) in ways.items() if (end := graph.endings[node]) is not None]
    _, _, _, ending, node = min(ends)
    steps = []
    for part, before in zip(reversed(parts), reversed(back), strict=True):
        steps.append({"_conv": part["_conv"], "_task": part["_task"], "_part": part["_part"], "from": before[node],
                      "to": node, "ending": ending})
        ending, node = "", before[node]
    return pa.Table.from_pylist(steps, pa.schema([
        ("_conv", pa.string()), ("_task", pa.int32()), ("_part", pa.int32()), ("from", pa.int32()),
        ("to", pa.int32()), ("ending", pa.string())]))


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts with their way: the part's own cost, audit and turns."""
    for batch in batches:
        out = []
        for part in batch.to_pylist():
            start, end, ending = part.pop("from"), part.pop("to"), part.pop("ending")
            way = next(w for w in part["ways"] if (w["from"], w["to"]) == (start, end))
            audit, roles = way["audit"] + "I" * len(ending), way["roles"] + ending
            out.append(part | {"cost": way["cost"] + INSERT * len(ending), "audit": audit,
                               "messages": _messages(part["held"], audit, roles), "held": None, "ways": None})
        yield pa.RecordBatch.from_pylist(out, _PART)


def _text(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(" "))


def last_mark(text: Column) -> Column:
    """The last character that is no white space; empty if there is none."""
    return F.right(F.rtrim(text, F.lit(BLANKS)), F.lit(1))


def repair(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    part_rows: int = PART_ROWS, part_bytes: int = PART_BYTES,
) -> DataFrame:
    """(conv, part, parts, rows, blank, duplicate, truncated, illegal, cost, audit, messages): each
    conversation with the least edits that make its roles an optional system turn and then pairs of
    user and assistant; one row, or numbered ones for a conversation of over ``part_rows`` rows.

    Rows are taken by turn (nulls first, ties by role and text). A row's first fault counts: blank,
    duplicate (role and text came before), truncated (its last character ends no sentence). Keeping
    costs 0, a new role 2, deleting 3 (the only edit of blank and duplicate rows), inserting an empty
    turn 2, leaving a truncated row 1. ``audit`` has the edits' initials, the least string among the
    cheapest; ``messages`` the repaired turns; ``illegal`` counts neighbours in the damaged rows whose
    role initials do not follow each other. Counts, cost and audit of a conversation are the sums, or
    the joined strings, of its parts; ``illegal`` of a part includes the pair across its start.

    The parser keeps all stacks in one graph and for each the cheapest (cost, audit). Rows are dealt
    out by ranges of (conversation, turn), so a conversation of any length is spread over tasks: a part
    of it becomes the cheapest ways between all stacks, the parts' small tables of ways are combined in
    order, and only then each part is repaired on its way. Equal rows are counted before the shuffle.

    Null conversations are one conversation; null roles and texts are one blank. A role whose initial
    the grammar does not have (an empty one, too) can not be kept. A very long text makes a part of its
    own. An empty table gives an empty one; other columns are not read, whatever they are called.
    """
    spark = turns.sparkSession
    kind = turns.select(quoted(conv)).schema[0].dataType
    rows = turns.select(
        quoted(conv).alias("_id"), quoted(turn).alias("_turn"), _text(quoted(role)).alias("role"),
        _text(quoted(text)).alias("text")).groupBy("_id", "_turn", "role", "text").agg(
        F.count("*").alias("copies"))
    # "=" keeps a null id apart from an empty one.
    name = F.coalesce(F.concat(F.lit("="), F.col("_id").cast("string")), F.lit(""))
    rows = stored(rows.select(
        name.alias("_conv"), "_turn", "role", "text", "copies",
        F.sha2(F.concat(F.length("role"), F.lit(":"), F.col("role"), F.col("text")), 256).alias("_what")), "turns")
    # Of a role and text that come in several turns, the first; most come once and are not joined.
    when = F.struct(F.col("_turn").isNotNull().alias("some"), F.col("_turn").alias("turn"))
    again = rows.groupBy("_conv", "_what").agg(F.count("*").alias("_times"), F.min(when).alias("_first")).where(
        "_times > 1").drop("_times")
    seen = F.col("_first").isNotNull() & (F.col("_first") != when)
    mark = last_mark(F.col("text"))
    fault = (F.when(mark == "", BLANK).when(F.coalesce(seen, F.lit(False)), DUPLICATE)
             .when(~mark.isin(".", "!", "?"), CUT).otherwise(OK))
    judged = spread_join(rows, again, ["_conv", "_what"], "_turn", "left").withColumn("fault", fault)
    order = [F.col("_conv"), F.col("_turn").asc_nulls_first(), F.col("role"), F.col("_what")]
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = stored(judged.repartitionByRange(tasks, *order).sortWithinPartitions(*order).select(
        "_conv", "role", "text", "fault", "copies").mapInArrow(_parts(part_rows, part_bytes), _PART_DDL), "parts")
    return _composed(parts).select(
        F.when(F.col("_conv") != "", F.substring("_conv", 2, 1 << 30)).cast(kind).alias(conv),
        "part", "parts", "rows", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "messages")


def _composed(parts: DataFrame) -> DataFrame:
    closed = parts.where("not open").select(
        "_conv", F.lit(0).cast("long").alias("part"), F.lit(1).cast("long").alias("parts"), "rows", "blank",
        "duplicate", "truncated", "illegal", "cost", "audit", "messages")
    opened = parts.where("open")
    # The audits stay where they are; their ranks within the part stand for them.
    audits = F.array_sort(F.array_distinct(F.transform("ways", lambda w: w["audit"])))
    ranked = opened.select("_conv", "_task", "_part", F.transform("ways", lambda w: F.struct(
        w["from"].alias("from"), w["to"].alias("to"), w["cost"].alias("cost"),
        F.array_position(audits, w["audit"]).cast("int").alias("rank"))).alias("ways"))
    steps = ranked.groupBy("_conv").applyInArrow(
        _chosen, "_conv string, _task int, _part int, from int, to int, ending string")
    # Numbers of the parts, and the role before each, from the small columns alone.
    along = Window.partitionBy("_conv").orderBy("_task", "_part")
    placed = opened.select(
        "_conv", "_task", "_part", (F.row_number().over(along) - 1).cast("long").alias("part"),
        F.count("*").over(Window.partitionBy("_conv")).alias("parts"),
        (F.coalesce(~F.concat(F.lag("last_role").over(along), "first_role").isin(*_LEGAL), F.lit(False))
         ).cast("long").alias("_across"))
    key = ["_conv", "_task", "_part"]
    applied = opened.join(steps, key).mapInArrow(
        _applied, _PART_DDL).join(placed, key).select(
        "_conv", "part", "parts", "rows", "blank", "duplicate", "truncated",
        (F.col("illegal") + F.col("_across")).alias("illegal"), "cost", "audit", "messages")
    return closed.unionByName(applied)


def damaged(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with faults that the checksum of ``conv_id:turn`` decides, of 20
    remainders: 0 drops the row, 1 empties its text, 2 takes its sentence ends, 3 repeats it, 4 makes
    it a user's. Nulls count as one blank."""
    fold = F.crc32(F.concat(_text(F.col("conv_id")), F.lit(":"), _text(F.col("turn")))) % 20
    text = _text(F.col("text"))
    return turns.withColumn("_fold", fold).where("_fold <> 0").select(
        "conv_id", "turn", F.when(F.col("_fold") == 4, "user").otherwise(_text(F.col("role"))).alias("role"),
        F.when(F.col("_fold") == 1, "").when(F.col("_fold") == 2, F.regexp_replace(text, "[.!?]", ""))
        .otherwise(text).alias("text"),
        F.explode(F.when(F.col("_fold") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    ).drop("_copy")


def turn_gaps(turns: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """(conv, gaps): whole turn numbers missing between the first and the last; 0 where all are null."""
    number = quoted(turn)
    return turns.groupBy(quoted(conv).alias(conv)).agg(F.coalesce(
        F.max(number) - F.min(number) + 1 - F.count_distinct(number), F.lit(0)).cast("long").alias("gaps"))


def _line(turn: Column) -> Column:
    return F.concat(turn["role"], F.lit(":"), turn["text"])


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each conversation's lines, over its parts in order; holds one digest."""
    conv, state, empty = None, None, True

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"_conv": conv, "sha256": state.hexdigest()}])

    for batch in batches:
        for row in batch.to_pylist():
            if row["_conv"] != conv:
                if state is not None:
                    yield done()
                conv, state, empty = row["_conv"], hashlib.sha256(), True
            for line in row["lines"]:
                state.update(line.encode() if empty else b"\n" + line.encode())
                empty = False
    if state is not None:
        yield done()


def digests(parts: DataFrame, conv: str = "conv_id") -> DataFrame:
    """(conv, sha256): the digest of the ``role:text`` lines of each repaired conversation, joined by
    line feeds. A conversation of one part is digested in its row; the parts of a longer one pass one
    task in order, since a digest depends on all bytes before, and leave only the digest in memory."""
    lines = F.transform("messages", _line)
    short = parts.where("parts = 1").select(
        quoted(conv), F.sha2(F.array_join(lines, "\n"), 256).alias("sha256"))
    name = F.coalesce(F.concat(F.lit("="), quoted(conv).cast("string")), F.lit(""))
    tasks = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    long = parts.where("parts > 1").select(name.alias("_conv"), "part", lines.alias("lines")).repartition(
        tasks, "_conv").sortWithinPartitions("_conv", "part").select("_conv", "lines").mapInArrow(
        _chained, "_conv string, sha256 string")
    kind = parts.schema[conv].dataType
    return short.unionByName(long.select(
        F.when(F.col("_conv") != "", F.substring("_conv", 2, 1 << 30)).cast(kind).alias(conv), "sha256"))
