import itertools
import random

import pytest

from tablelab.llm import chat


def cheapest(roles):
    """Least cost over all labels, merges and insertions, by enumeration."""
    best = None
    options = [(label, how) for label in chat.ROLES for how in ("new", "merge", "insert user", "insert assistant")]
    for picks in itertools.product(options, repeat=len(roles)):
        cost, seq = 0, []
        for role, (label, how) in zip(roles, picks, strict=True):
            cost += chat.label_cost(role, label)
            if how == "merge":
                if not seq or seq[-1] != label:
                    break
                cost += chat.MERGE
                continue
            if how != "new":
                cost += chat.INSERT
                seq.append(how.split()[1])
            seq.append(label)
        else:
            while seq and (seq[-1] != "assistant"):
                seq.append("assistant" if seq[-1] == "user" else "user")
                cost += chat.INSERT
            if legal(seq) and (best is None or cost < best):
                best = cost
    return best


def legal(seq):
    rest = seq[1:] if seq[:1] == ["system"] else seq
    return rest == ["user", "assistant"] * (len(rest) // 2) and (rest or not seq)


def messages(text):
    parts = text.split(chat.END)
    assert parts[-1] == ""
    return [p[2 : p.index("|>")] for p in parts[:-1]]


@pytest.mark.parametrize("n", [1, 2, 3])
def test_cost_is_the_least(n):
    for roles in itertools.product((*chat.ROLES, None), repeat=n):
        assert chat.boundaries([chat.run_costs(list(roles))])[0] == cheapest(roles), roles


def test_rendered_conversation_is_legal_and_runs_do_not_matter():
    rng = random.Random(1)
    for _ in range(200):
        turns = [(rng.choice(["system", "user", "assistant", "human", "tool", None]), rng.choice(["a", None, "<|end|>\n", "b c"])) for _ in range(rng.randint(1, 14))]
        roles = [chat.role_of(r) for r, _ in turns]
        whole, [(before, after)] = chat.boundaries([chat.run_costs(roles)])
        done = chat.render(turns, before, after, True)
        text = "".join(d["piece"] for d in done)
        assert legal(messages(text))
        assert all(chat.escape(t) in d["piece"] for (_, t), d in zip(turns, done, strict=True))
        cuts = sorted(rng.sample(range(1, len(turns)), min(2, len(turns) - 1)))
        runs = [turns[a:b] for a, b in zip([0, *cuts], [*cuts, len(turns)], strict=True)]
        cost, states = chat.boundaries([chat.run_costs([chat.role_of(r) for r, _ in t]) for t in runs])
        assert cost == whole
        pieces = [d["piece"] for k, (t, (a, b)) in enumerate(zip(runs, states, strict=True)) for d in chat.render(t, a, b, k == len(runs) - 1)]
        assert legal(messages("".join(pieces)))


def test_clean_conversations_stay(spark):
    rows = [(1, k, r, f"t{k}", 0) for k, r in enumerate(["system", "user", "assistant", "user", "assistant"])]
    got = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, piece int")).collect()
    assert {r["action"] for r in got} == {"keep"} and {r["cost"] for r in got} == {0}


def test_spark_long_conversation_and_edges(spark):
    rng = random.Random(2)
    rows = [(7, k, rng.choice(["user", "assistant", None]), f"t{k}", "x") for k in range(3000)]
    rows += [(8, 0, "user", "hi", "x"), (8, 0, "user", "hi", "x"), (8, None, "assistant", None, "x"), (8, 1, "user", "", "x"),
             (None, 0, "user", "lost", "x"), (None, 0, "assistant", "lost", "x"), (9, 0, "system", "only", "x"), (None, None, None, None, "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, key string")
    small = {(r["conv"], r["turn"], r["role"], r["text"]): r for r in chat.format_chats(df, run=10).collect()}
    large = chat.format_chats(df, run=10**9).collect()
    assert len(small) == len(large) == len(set(rows))
    for r in large:
        assert small[r["conv"], r["turn"], r["role"], r["text"]]["cost"] == r["cost"]
    for rows_of in (small.values(), large):
        order = lambda r: (r["turn"] is None, r["turn"])
        text = "".join(r["piece"] for r in sorted((r for r in rows_of if r["conv"] == 7), key=order))
        assert legal(messages(text))
        assert legal(messages("".join(r["piece"] for r in sorted((r for r in rows_of if r["conv"] == 8), key=order))))
    nulls = [r for r in large if r["conv"] is None]
    assert len(nulls) == 3 and all(legal(messages(r["piece"])) for r in nulls)
    only = next(r for r in large if r["conv"] == 9)
    assert messages(only["piece"]) == ["system", "user", "assistant"] and only["closed_by"] == ["user", "assistant"]
    assert chat.format_chats(df.limit(0)).count() == 0


def test_equal_rows_without_a_turn_number_all_stay(spark):
    rows = [(1, None, "user", "ok", 1), (1, None, "user", "ok", 1), (1, None, "user", "ok", 2), (2, 0, "user", "ok", 1), (2, 0, "user", "ok", 2),
            (2, 0, "user", "ok", 2), (None, None, "user", "ok", 1), (None, None, "user", "ok", 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, message_id int")
    got = chat.format_chats(df).collect()
    assert sorted(str(r["conv"]) for r in got) == ["1"] * 3 + ["2"] * 2 + ["None"] * 2
    assert all(legal(messages(r["piece"])) for r in got if r["conv"] is None)
    for c in (1, 2):
        text = "".join(r["piece"] for r in sorted((r for r in got if r["conv"] == c), key=lambda r: r["action"]))
        assert legal(messages(text)) and text.count("ok") == len([r for r in got if r["conv"] == c])
    many = spark.range(10_000).selectExpr("1L as conv_id", "cast(null as long) as turn", "'user' as role", "'ok' as text")
    assert chat.format_chats(many).count() == 10_000
