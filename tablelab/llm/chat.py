"""Chat formatting by minimum-cost role repair.

A legal conversation is an optional system message, then user and assistant messages in
turn, the last by the assistant.  An automaton with four states (nothing yet, system,
user, assistant last) accepts these.  Each turn is kept, relabelled, merged into the
message before it, or preceded by an empty message; every choice has a cost, and dynamic
programming finds the cheapest sequence of choices.

Costs of a run of turns are a 4 x 4 table (state before, state after), and tables of
adjoining runs combine by min and plus.  So a conversation is cut into runs of bounded
length, runs are solved wherever they lie, one small table per run is combined by
conversation, and each run is rendered between its states.  A conversation that holds a
third of all turns is spread like the others.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelab.llm import packed
from tablelab.llm.common import col

ROLES = ("system", "user", "assistant")
#: Other names of the roles; anything else, and null, is of no role.
ALIASES = {"human": "user", "prompter": "user", "bot": "assistant", "ai": "assistant", "gpt": "assistant", "model": "assistant"}
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = {"system": SYSTEM, "user": USER, "assistant": ASSISTANT}
#: Which message may follow in each state, and the state it leads to.
LEGAL = {START: ("system", "user"), SYSTEM: ("user",), USER: ("assistant",), ASSISTANT: ("user",)}
#: Merging, relabelling a turn, one from or to system, one of no role, and an empty message.
MERGE, RELABEL, RELABEL_SYSTEM, LABEL, INSERT = 2, 5, 7, 3, 6
RUN = 512
INFINITE = 1 << 40
_RUNS = "key string, run long, costs array<long>"
_BOUNDS = "key string, run long, before int, after int, last boolean, cost long"


def role_of(name: str | None) -> str | None:
    name = (name or "").strip().lower()
    return name if name in ROLES else ALIASES.get(name)


def label_cost(role: str | None, label: str) -> int:
    if role == label:
        return 0
    return LABEL if role is None else RELABEL_SYSTEM if "system" in (role, label) else RELABEL


def choices(state: int, role: str | None) -> list[tuple[int, int, str, str]]:
    """``(cost, next state, label, how)`` of a turn in a state; how: keep, merge or the role inserted before."""
    out = []
    for label in ROLES:
        price = label_cost(role, label)
        if label in LEGAL[state]:
            out.append((price, STATES[label], label, "keep"))
        if state == STATES[label]:
            out.append((price + MERGE, state, label, "merge"))
        for between in LEGAL[state]:
            if between != "system" and label in LEGAL[STATES[between]]:
                out.append((price + INSERT, STATES[label], label, between))
    return out


_CHOICES = {(s, r): choices(s, r) for s in range(4) for r in (*ROLES, None)}


def closing(state: int) -> list[str]:
    """Empty messages that end a conversation in this state."""
    return {START: [], SYSTEM: ["user", "assistant"], USER: ["assistant"], ASSISTANT: []}[state]


def run_costs(roles: list[str | None]) -> list[list[int]]:
    """Least cost from each state before a run to each state after it."""
    out = []
    for first in range(4):
        now = [INFINITE] * 4
        now[first] = 0
        for role in roles:
            then = [INFINITE] * 4
            for state, spent in enumerate(now):
                if spent < INFINITE:
                    for price, to, _, _ in _CHOICES[state, role]:
                        then[to] = min(then[to], spent + price)
            now = then
        out.append(now)
    return out


def best_path(roles: list[str | None], before: int, after: int) -> list[tuple[int, int, str, str]]:
    """The cheapest choices of a run between two states; of equals the first by state and order."""
    spent, back = [0 if s == before else INFINITE for s in range(4)], []
    for role in roles:
        then, how = [INFINITE] * 4, [None] * 4
        for state in range(4):
            if spent[state] < INFINITE:
                for choice in _CHOICES[state, role]:
                    if spent[state] + choice[0] < then[choice[1]]:
                        then[choice[1]], how[choice[1]] = spent[state] + choice[0], (state, choice)
        back.append(how)
        spent = then
    out, state = [], after
    for how in reversed(back):
        state, choice = how[state]
        out.append(choice)
    return out[::-1]


def boundaries(tables: list[list[list[int]]]) -> tuple[int, list[tuple[int, int]]]:
    """The least cost of a conversation of these runs, and the states around each run."""
    ahead = [[INSERT * len(closing(s)) for s in range(4)]]
    for t in reversed(tables):
        ahead.append([min(t[s][e] + ahead[-1][e] for e in range(4)) for s in range(4)])
    ahead.reverse()
    state, out = START, []
    for t, rest in zip(tables, ahead[1:], strict=True):
        to = min(range(4), key=lambda e: t[state][e] + rest[e])
        out.append((state, to))
        state = to
    return ahead[0][START], out


def escape(text: str | None) -> str:
    """Text that holds no marker."""
    return (text or "").replace("<|", "<\\|")


def message(role: str, text: str | None) -> str:
    return f"<|{role}|>\n{escape(text)}"


END = "<|end|>\n"


def render(turns: list[tuple[str | None, str | None]], before: int, after: int, last: bool) -> list[dict]:
    """For each (role, text) of a run what becomes of it, and its piece of the rendered conversation.

    Pieces, one after another over all runs, are the conversation.
    """
    roles = [role_of(r) for r, _ in turns]
    out, state = [], before
    for (_, text), role, (_, to, label, how) in zip(turns, roles, best_path(roles, before, after), strict=True):
        head = "" if state == START else END
        inserted = [] if how in ("keep", "merge") else [how]
        if how == "merge":
            piece = "\n\n" + escape(text)
        else:
            piece = head + "".join(message(r, "") + END for r in inserted) + message(label, text)
        action = "merge" if how == "merge" else "keep"
        if role != label:
            action = "relabel" if action == "keep" else "relabel and merge"
        out.append({"new_role": label, "action": action, "inserted": inserted, "piece": piece})
        state = to
    if last and out:
        out[-1]["piece"] += END + "".join(message(r, "") + END for r in closing(state))
        out[-1]["closed_by"] = closing(state)
    return out


def _sorted_runs(table: pa.Table) -> list[tuple[str, int, list[dict]]]:
    runs: dict[tuple[str, int], list[dict]] = {}
    for row in table.to_pylist():
        runs.setdefault((row["key"], row["run"]), []).append(row)
    def order(r):
        return (r["turn"] is None, r["turn"] or 0, r["role"] or "", r["text"] or "", r["text"] is not None)
    return [(key, run, sorted(rows, key=order)) for (key, run), rows in sorted(runs.items())]


def format_chats(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    run: int = RUN,
) -> DataFrame:
    """``(conv, turn, role, text, new_role, action, inserted, closed_by, piece, cost)`` per turn.

    ``inserted``: roles of empty messages before the turn; ``closed_by``: of those after the
    last one; ``cost``: that of the whole conversation.  ``piece`` in the order of turns
    makes the rendered conversation.  Turns are whole numbers, null last; of one number by
    role and text.  Rows that are alike in all columns and have a turn number are one turn;
    without a number, or if another column differs, each is a turn.  A null text is empty; a
    row without a conversation is one by itself.  Other columns are left out.
    """
    used = {c.lower() for c in (conv_col, turn_col, role_col, text_col)}
    others = [col(c) for c in turns.columns if c.lower() not in used]
    text = turns.select(
        col(conv_col).alias("conv"), col(turn_col).cast("long").alias("turn"), col(role_col).alias("role"), col(text_col).alias("text"),
        (F.sha1(F.to_json(F.struct(*others)).cast("binary")) if others else F.lit("")).alias("other"),
    ).groupBy("conv", "turn", "role", "text", "other").agg(F.count(F.lit(1)).alias("n"))
    # A row for each repetition; in two steps, so that no list of them is long.
    last = F.when(F.col("turn").isNull(), F.col("n") - 1).otherwise(F.lit(0))
    text = text.withColumn("last", last).withColumn("some", F.explode(F.expr("sequence(0L, last, 4096L)")))
    text = text.withColumn("nth", F.explode(F.expr("sequence(some, least(some + 4095L, last))")))
    own = F.concat(
        F.lit("row "), F.sha1(F.to_json(F.struct("turn", "role", "text")).cast("binary")), F.lit(" "), "other", F.lit(" "), F.col("nth").cast("string")
    )
    text = text.withColumn("key", F.coalesce(F.concat(F.lit("conv "), F.col("conv").cast("string")), own))
    text = text.select("conv", "turn", "role", "text", "key")
    # Runs are ranges of turn numbers, so no conversation needs sorting as a whole.
    text = text.withColumn("run", F.coalesce(F.floor(F.col("turn") / run), F.lit((1 << 62))).cast("long"))
    size = turns.agg(F.sum(F.octet_length(col(text_col)).cast("long"))).first()[0] or 0
    groups = size // packed.GROUP_BYTES + 1
    dealt = lambda df, *by: df.withColumn("g", F.pmod(F.xxhash64(*by), F.lit(groups)))

    def solve(table: pa.Table) -> pa.Table:
        rows = [(key, n, sum(run_costs([role_of(r["role"]) for r in rows]), [])) for key, n, rows in _sorted_runs(table)]
        return pa.table({
            "key": pa.array([r[0] for r in rows], pa.string()), "run": pa.array([r[1] for r in rows], pa.int64()),
            "costs": pa.array([r[2] for r in rows], pa.list_(pa.int64())),
        })

    def combine(table: pa.Table) -> pa.Table:
        by_key: dict[str, list[tuple[int, list[int]]]] = {}
        for row in table.to_pylist():
            by_key.setdefault(row["key"], []).append((row["run"], row["costs"]))
        rows = []
        for key, runs in by_key.items():
            runs.sort()
            cost, states = boundaries([[c[4 * s : 4 * s + 4] for s in range(4)] for _, c in runs])
            rows += [(key, n, a, b, i == len(runs) - 1, cost) for i, ((n, _), (a, b)) in enumerate(zip(runs, states, strict=True))]
        types = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64()]
        names = [x.split()[0] for x in _BOUNDS.split(", ")]
        return pa.table({n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate(zip(names, types, strict=True))})

    conv_type = dict(text.dtypes)["conv"]
    strings = pa.list_(pa.string())

    def write(table: pa.Table, bounds: pa.Table) -> pa.Table:
        told = {(b["key"], b["run"]): b for b in bounds.to_pylist()}
        out = []
        for key, n, rows in _sorted_runs(table):
            b = told[key, n]
            done = render([(r["role"], r["text"]) for r in rows], b["before"], b["after"], b["last"])
            out += [r | d | {"cost": b["cost"]} for r, d in zip(rows, done, strict=True)]
        fields = [("conv", table.schema.field("conv").type), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()),
                  ("new_role", pa.string()), ("action", pa.string()), ("inserted", strings), ("closed_by", strings),
                  ("piece", pa.string()), ("cost", pa.int64())]
        return pa.table({n: pa.array([r.get(n, [] if t == strings else None) for r in out], t) for n, t in fields})

    by_run = dealt(text, "key", "run").groupBy("g")
    solved = by_run.applyInArrow(solve, _RUNS)
    bounds = dealt(solved, "key").groupBy("g").applyInArrow(combine, _BOUNDS)
    return by_run.cogroup(dealt(bounds, "key", "run").groupBy("g")).applyInArrow(
        write,
        f"conv {conv_type}, turn long, role string, text string, new_role string, action string, inserted array<string>, "
        "closed_by array<string>, piece string, cost long",
    )
