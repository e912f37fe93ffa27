"""Conversation structure repair: the cheapest edits that give every conversation its form, by a Viterbi search.

The form is ``(s?(ua)+)?`` over the initials of the roles: perhaps one system row, then user and assistant in turn, or nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphtables.llm.common import crc32_sql, read, settled

#: The costs of edits, and what an undeleted truncated row adds.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: States of the form: nothing yet, after the system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Initial of a role -> the states it may follow, and the state it leads to.
STEPS = {"s": ((START,), SYSTEM), "u": ((START, SYSTEM, ASSISTANT), USER), "a": ((USER,), ASSISTANT)}
ROLE = {"u": "user", "a": "assistant"}
BLANK = r"^[\x20\x09-\x0D]*\z"
ENDED = r"[.!?][\x20\x09-\x0D]*\z"
#: Edits that come out as one batch.
ROWS = 2000


class Step:
    """An edit in the backpointer tree; ``uses`` counts the later edits and the survivors that point at it.

    ``key`` stands for all edits up to this one where equally cheap ones are compared: the rank, by their edits, of the survivor of the
    last row that it comes from, and the letters since. Survivors of a row end in an edit of that row, so none begins
    with another, and their ranks decide for whatever follows them.
    """

    __slots__ = ("after", "before", "cost", "edit", "initial", "key", "row", "uses")

    def __init__(self, before, cost, edit="", initial="", row=None):
        self.before, self.cost, self.edit, self.initial, self.row = before, cost, edit, initial, row
        self.after: list[Step] = []
        self.uses = 0
        self.key = (0, "")
        if before is not None:
            self.key = (before.key[0], before.key[1] + edit)
            before.after.append(self)
            before.uses += 1


def _released(step: Step) -> None:
    """Takes one use away, and forgets edits that nothing points at any more."""
    step.uses -= 1
    while not step.uses and step.before is not None:
        before, step.before = step.before, None
        before.after.remove(step)
        before.uses -= 1
        step = before


class Repair:
    """The search over one conversation: rows go in one by one, edits come out as soon as no survivor disagrees on them.

    There is one survivor per state. The survivors' edits are a tree of backpointers; edits that were outdone are forgotten when
    nothing points at them. While one edit alone follows the root of the tree, all survivors share it: it comes out and is
    the root from then on. So what is held are the edits since the survivors' last common one. Survivors that can not
    win any more are given up: what follows the state START or SYSTEM may follow ASSISTANT as well, but for
    a system row, which can be deleted there.
    """

    def __init__(self):
        self.root = Step(None, 0)
        self.root.uses = 1
        self.survivors: dict[int, Step] = {START: self.root}

    @staticmethod
    def _offer(best: dict[int, Step], state: int, step: Step) -> None:
        """``step`` takes its state's place if it is cheaper than what is there, or as cheap with the lesser edits."""
        step.uses += 1
        held = best.get(state)
        if held is None or (step.cost, step.key) < (held.cost, held.key):
            best[state], step = step, held
        if step is not None:
            _released(step)

    def _turn(self, best: dict[int, Step]) -> None:
        old, self.survivors = self.survivors, best
        for step in old.values():
            _released(step)

    def _insert(self) -> None:
        """Lets insertions lead to other states; two at most, as more come back to a state."""
        best: dict[int, Step] = {}
        for state, step in self.survivors.items():
            self._offer(best, state, step)
        latest = self.survivors
        for _ in range(2):
            reached: dict[int, Step] = {}
            for state, step in latest.items():
                for initial, (after, to) in STEPS.items():
                    if initial in ROLE and state in after:
                        self._offer(reached, to, Step(step, step.cost + INSERT, "I", initial))
            for state, step in reached.items():
                self._offer(best, state, step)
            for state in [s for s, x in reached.items() if best[s] is not x]:
                _released(reached.pop(state))
            if latest is not self.survivors:
                for step in latest.values():
                    _released(step)
            latest = reached
        for step in latest.values():
            _released(step)
        self._turn(best)

    def add(self, row, initial: str, must_go: bool, truncated: bool) -> Iterator[Step]:
        """The edits that this row settles."""
        self._insert()
        more = TRUNCATED if truncated else 0
        best: dict[int, Step] = {}
        for state, step in self.survivors.items():
            self._offer(best, state, Step(step, step.cost + DELETE, "D", "", row))
            if must_go:
                continue
            for to_initial, (after, to) in STEPS.items():
                if state not in after:
                    continue
                if to_initial == initial:
                    self._offer(best, to, Step(step, step.cost + KEEP + more, "K", initial, row))
                if to_initial in ROLE:
                    self._offer(best, to, Step(step, step.cost + REROLE + more, "R", to_initial, row))
        self._turn(best)
        self._give_up()
        ranked = sorted(best.values(), key=lambda s: s.key)
        for rank, step in enumerate(ranked):
            step.key = (rank, "")
        while self.root.uses == 1 and self.root.after:
            self.root = self.root.after[0]
            self.root.before = None
            yield self.root

    def _give_up(self) -> None:
        sure = min([s.cost + INSERT * (state == USER) for state, s in self.survivors.items() if state in (USER, ASSISTANT)], default=None)
        for state, more in ((START, DELETE), (SYSTEM, 0)):
            if sure is not None and state in self.survivors and self.survivors[state].cost > sure + more:
                _released(self.survivors.pop(state))

    def end(self) -> Iterator[Step]:
        """The rest of the edits."""
        self._insert()
        ends: dict[int, Step] = {}
        for state in (START, ASSISTANT):
            if state in self.survivors:
                self._offer(ends, START, self.survivors[state])
        chain, step = [], ends[START]
        while step is not self.root:
            chain.append(step)
            step = step.before
        yield from reversed(chain)


def _rows(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    for batch in batches:
        yield from batch.itertuples(index=False, name=None)


def _repaired(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (conv_id, turn, role, text, blank, seen, ended), each conversation in order, to edits."""
    out: list[tuple] = []
    columns = ["conv_id", "place", "edit", "turn", "was", "fault", "role", "text", "cost"]

    def put(conv, place, step):
        turn, was, text, fault = step.row or (None, None, "", None)
        role = None if step.edit == "D" else was if step.edit == "K" else ROLE[step.initial]
        out.append((conv, place, step.edit, turn, was, fault, role, text, step.cost))

    def batch(n):
        full = pd.DataFrame(out[:n], columns=columns)
        del out[:n]
        return full

    search, conv, place, previous = None, None, 0, None
    for conv_id, turn, role, text, blank, seen, ended in _rows(batches):
        if search is None or conv_id != conv:
            if search is not None:
                for step in search.end():
                    put(conv, place := place + 1, step)
            search, conv, place, previous = Repair(), conv_id, 0, None
        copy = previous == (turn, role, text)
        previous = (turn, role, text)
        fault = "blank" if blank else "duplicate" if seen or copy else None if ended else "truncated"
        row = (turn, role, text, fault)
        for step in search.add(row, role[:1], fault in ("blank", "duplicate"), fault == "truncated"):
            put(conv, place := place + 1, step)
        if len(out) >= ROWS:
            yield batch(ROWS)
    if search is not None:
        for step in search.end():
            put(conv, place := place + 1, step)
    while out:
        yield batch(ROWS)


#: Ids and turns go to Python as text: as numbers they would be rounded beside a null.
EDITS = "conv_id string, place long, edit string, turn string, was string, fault string, role string, text string, cost long"


def repair(rows: DataFrame) -> DataFrame:
    """The edits of every conversation: conv_id, place (1, 2, ...), edit (K, R, D, I), turn, was, fault, role, text, cost.

    ``rows`` has conv_id, turn, role and text; other columns are not looked at. A null role or text counts as one space, a
    null conv_id is a conversation, a null turn comes first. Rows of one turn are ordered by role and text. A row's fault
    is the first of blank (only white space, or empty), duplicate (a row of the same role and text came before) and truncated (it does not end in one
    of .!?). Blank and duplicate rows are deleted (D); any other is kept (K), given the role of user or assistant (R) or
    deleted; empty rows of user or assistant are inserted (I). Of the cheapest edits those whose letters are least in ASCII
    are taken. The repaired conversation are the rows with a role, in the order of place. ``cost`` is the cost up to that edit.
    A table without rows gives none.

    Whether a row was seen before is found by a grouping and a join, so nothing remembers a conversation. The search goes
    through each conversation in order and holds what is not settled yet, whatever the conversation's length. The edits
    of a conversation follow each other in one partition of the result.
    """
    own = rows.select("conv_id", "turn", *[F.coalesce(rows[c], F.lit(" ")).alias(c) for c in ("role", "text")])
    own = settled(own.withColumn("key", F.sha2(F.col("text").cast("binary"), 256)), "conversations")
    first = own.groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("key").alias("k")).agg(
        F.min("turn").alias("first"), F.max(F.col("turn").isNull()).alias("unplaced"))
    same = own["conv_id"].eqNullSafe(first["c"]) & (own["role"] == first["r"]) & (own["key"] == first["k"])
    seen = F.col("turn").isNotNull() & (F.col("unplaced") | (F.col("turn") > F.col("first")))
    marked = own.join(first.hint("merge"), same).select(
        "conv_id", "turn", "role", "text", F.col("text").rlike(BLANK).alias("blank"), F.coalesce(seen, F.lit(False)).alias("seen"),
        F.col("text").rlike(ENDED).alias("ended"),
    )
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text"]
    dealt = marked.repartition("conv_id").sortWithinPartitions(*order)
    texts = [F.col(c).cast("string").alias(c) for c in ("conv_id", "turn")]
    edits = dealt.select(*texts, "role", "text", "blank", "seen", "ended").mapInPandas(_repaired, EDITS)
    return edits.withColumns({c: F.col(c).cast(own.schema[c].dataType) for c in ("conv_id", "turn")})


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations (conv_id, turn, role, text) with faults by crc32 of conv_id:turn, a null being one space."""
    part = lambda c: F.coalesce(rows[c].cast("string"), F.lit(" "))
    own = rows.select(
        "conv_id", "turn", *[F.coalesce(rows[c], F.lit(" ")).alias(c) for c in ("role", "text")],
        (F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20).alias("kind"),
    )
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    kept = own.where("kind != 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("time"))
    return kept.drop("time")


_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
DIGEST = "conv_id string, " + ", ".join(f"{c} long" for c in _COUNTS) + ", audit string, repaired_sha256 string"


def _digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edits, conversation after conversation, to one row each."""
    out: list[tuple] = []
    conv, now = None, None

    def close():
        turns = now["turns"]
        gaps = now["last"] - now["first"] + 1 - turns if turns else 0
        out.append((conv, gaps, *[now[c] for c in _COUNTS[1:]], "".join(now["audit"]), now["sha"].hexdigest()))

    for conv_id, _, edit, turn, was, fault, role, text, cost in _rows(batches):
        turn = None if turn is None else int(turn)
        if now is None or conv_id != conv:
            if now is not None:
                close()
            conv, now = conv_id, {c: 0 for c in _COUNTS} | {"turns": 0, "first": None, "last": None, "audit": [], "sha": hashlib.sha256(), "rows": 0, "was": None}
        now["audit"].append(edit)
        now["cost"] = int(cost)
        if edit != "I":
            if fault:
                now[fault] += 1
            if turn is not None and turn != now["last"]:
                now["turns"] += 1
                now["first"], now["last"] = turn if now["first"] is None else now["first"], turn
            now["illegal"] += now["was"] is not None and now["was"] + was[:1] not in ("su", "ua", "au")
            now["was"] = was[:1]
        if role is not None:
            now["sha"].update(("\n" * (now["rows"] > 0) + f"{role}:{text}").encode("utf-8", "surrogatepass"))
            now["rows"] += 1
        if len(out) >= ROWS:
            yield pd.DataFrame(out, columns=["conv_id", *_COUNTS, "audit", "repaired_sha256"])
            out.clear()
    if now is not None:
        close()
    yield pd.DataFrame(out, columns=["conv_id", *_COUNTS, "audit", "repaired_sha256"])


def op13_conversation_repair(spark, sf_dir):
    """What ``repair`` does to damaged conversations, a row for each conversation, also for those without rows after the damage."""
    rows = read(spark, sf_dir, "conversations")
    edits = repair(damaged(rows))
    texts = {c: F.col(c).cast("string") for c in ("conv_id", "turn")}
    done = edits.withColumns(texts).mapInPandas(_digest, DIGEST).withColumnRenamed("conv_id", "c")
    every = rows.select("conv_id").distinct()
    joined = every.join(done, F.col("conv_id").cast("string").eqNullSafe(F.col("c")), "left")
    counts = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in _COUNTS]
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return joined.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))


QUERIES = {"op13_conversation_repair": op13_conversation_repair}

# SQL tables of what STEPS says: insertions between two rows, and edits of a row, by state.
_MOVES = """VALUES (0, '', 0), (1, '', 1), (2, '', 2), (3, '', 3), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3),
                   (0, 'ua', 3), (1, 'ua', 3)"""
_EDITS = """VALUES (0, 'D', '', 0), (1, 'D', '', 1), (2, 'D', '', 2), (3, 'D', '', 3), (0, 'K', 's', 1),
                   (0, 'K', 'u', 2), (1, 'K', 'u', 2), (3, 'K', 'u', 2), (2, 'K', 'a', 3),
                   (0, 'R', 'u', 2), (1, 'R', 'u', 2), (3, 'R', 'u', 2), (2, 'R', 'a', 3)"""
_EMPTY = "CASE ins WHEN '' THEN '' WHEN 'u' THEN chr(10) || 'user:' WHEN 'a' THEN chr(10) || 'assistant:' ELSE chr(10) || 'user:' || chr(10) || 'assistant:' END"

ORACLE = {
    "op13_conversation_repair": f"""
        WITH RECURSIVE own AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   {crc32_sql("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS kind
            FROM conversations
        ), damaged AS (
            SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                   CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
            FROM own WHERE kind <> 0
        ), placed AS (
            SELECT *, row_number() OVER along AS i, lag(left(role, 1)) OVER along AS was,
                   row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth
            FROM damaged WINDOW along AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)
        ), marked AS (
            SELECT *, CASE WHEN regexp_full_match(text, '[\\x20\\x09-\\x0D]*') THEN 'blank' WHEN nth > 1 THEN 'duplicate'
                           WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 'truncated' ELSE '' END AS fault
            FROM placed
        ), counted AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, max(i) AS n,
                   count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                   count(*) FILTER (fault = 'truncated') AS truncated,
                   count(*) FILTER (was IS NOT NULL AND was || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal
            FROM marked GROUP BY conv_id
        ), moves(f, ins, t) AS ({_MOVES}), edits(f, edit, initial, t) AS ({_EDITS}), search AS (
            SELECT conv_id, 0::BIGINT AS i, 0 AS state, 0::BIGINT AS cost, '' AS audit, '' AS lines FROM counted
            UNION ALL
            SELECT conv_id, i, state, cost, audit, lines FROM (
                SELECT s.conv_id, p.i, e.t AS state,
                       s.cost + 2 * length(ins) + CASE edit WHEN 'D' THEN 3 WHEN 'R' THEN 2 ELSE 0 END
                           + (edit <> 'D' AND fault = 'truncated')::INT AS cost,
                       s.audit || repeat('I', length(ins)) || edit AS audit,
                       s.lines || {_EMPTY} || CASE edit WHEN 'D' THEN '' ELSE chr(10) || CASE edit WHEN 'K' THEN role
                           ELSE CASE initial WHEN 'u' THEN 'user' ELSE 'assistant' END END || ':' || text END AS lines
                FROM search s JOIN moves m ON m.f = s.state
                JOIN marked p ON p.conv_id IS NOT DISTINCT FROM s.conv_id AND p.i = s.i + 1
                JOIN edits e ON e.f = m.t AND (edit = 'D' OR fault NOT IN ('blank', 'duplicate'))
                            AND (edit <> 'K' OR initial = left(role, 1))
            ) QUALIFY row_number() OVER (PARTITION BY conv_id, state ORDER BY cost, audit) = 1
        ), ended AS (
            SELECT s.conv_id, s.cost + 2 * length(ins) AS cost, s.audit || repeat('I', length(ins)) AS audit, s.lines || {_EMPTY} AS lines
            FROM search s JOIN counted c ON c.conv_id IS NOT DISTINCT FROM s.conv_id AND c.n = s.i
            JOIN moves m ON m.f = s.state AND m.t IN (0, 3)
            QUALIFY row_number() OVER (PARTITION BY s.conv_id ORDER BY s.cost + 2 * length(ins), s.audit || repeat('I', length(ins))) = 1
        )
        SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
               coalesce(audit, '') AS audit, sha256(coalesce(substr(lines, 2), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) c
        LEFT JOIN counted d ON d.conv_id IS NOT DISTINCT FROM c.conv_id
        LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
    """,
}
