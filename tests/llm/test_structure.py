"""Conversation repair against a search over all edits of each conversation."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from itertools import pairwise

import pytest
from pyspark.sql import functions as F

from featuremart.llm import structure
from featuremart.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, symbol string, n string, at string"


def hurt(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def faults(rows):
    """Faults of one conversation's rows in order."""
    seen, out = set(), []
    for _, _, role, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not words else "duplicate" if (role, text) in seen
                   else "truncated" if words[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def cheapest(rows, wrong):
    """(cost, audit, turns) by trying every edit, rows from the last to the first, whole strings kept."""
    follows = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    names = {"u": "user", "a": "assistant"}
    done = {}

    def go(i, state, inserted):
        key = i, state, inserted
        if key in done:
            return done[key]
        found = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        if inserted < 2:
            for r, name in names.items():
                if (state, r) in follows:
                    cost, audit, turns = go(i, r, inserted + 1)
                    found.append((cost + 3, "I" + audit, ((name, ""), *turns)))
        if i < len(rows):
            _, _, role, text = rows[i]
            extra = 3 if wrong[i] == "truncated" else 0
            choices = [("D", 4, state, ())]
            if wrong[i] not in ("blank", "duplicate"):
                if (state, role[:1]) in follows:
                    choices.append(("K", extra, role[:1], ((role, text),)))
                choices += [("R", 3 + extra, r, ((name, text),)) for r, name in names.items() if (state, r) in follows]
            for letter, price, to, turn in choices:
                cost, audit, turns = go(i + 1, to, 0)
                found.append((cost + price, letter + audit, (*turn, *turns)))
        done[key] = min(found, default=(10**9, "", ()))
        return done[key]

    return go(0, "", 0)


def brute(rows):
    by_conv = defaultdict(list)
    for row in hurt(rows):
        by_conv[row[0]].append(row)
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted(by_conv[conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        wrong = faults(mine)
        cost, audit, turns = cheapest(mine, wrong)
        known = {r[1] for r in mine if r[1] is not None}
        illegal = sum((a[2][:1] or " ") + (b[2][:1] or " ") not in ("su", "ua", "au") for a, b in pairwise(mine))
        whole = "\n".join(f"{role}:{text}" for role, text in turns)
        out[conv] = (max(known) - min(known) + 1 - len(known) if known else 0,
                     *(wrong.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
                     hashlib.sha256(whole.encode()).hexdigest())
    return out


def run(spark, rows, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("conversations"))
    spark.createDataFrame([(*r, "old", "old", "old") for r in rows], SCHEMA).write.parquet(f"{folder}/conversations.parquet")
    got = QUERIES["op13_structure"](spark, folder).collect()
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    found = {r.conv_id: tuple(r[c] for c in names) for r in got}
    assert len(found) == len(got)
    return found


TEXTS = ["So be it.", "Why?", "no end", "Yes!", " \t", "", "a. \n", "b.\n\nc", "tail .x", None]


def some_rows(seed, conversations, longest):
    rng = random.Random(seed)
    rows = []
    for conv in range(conversations):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.4 else ["user", "assistant"][turn % 2]
            if turn == 0 and rng.random() < 0.4 or rng.random() < 0.05:
                role = rng.choice(["system", "tool", None, "", "ünder", "s"])
            text = rng.choice(TEXTS) if rng.random() < 0.5 else f"Line {rng.randint(0, 30)}."
            rows.append((conv, turn * rng.choice([1, 1, 1, 2]), role, text))
    return rows


def test_equal_to_trying_every_edit(spark, tmp_path_factory):
    rows = some_rows(1, 150, 9) + [(None, 1, "user", "Hm."), (None, None, "assistant", "Oh."), (900, None, None, None),
                                   (901, 3, "user", "Same."), (901, 3, "user", "Same."), (901, 3, "user", "Other.")]
    dropped = next(c for c in range(1_000, 2_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((dropped, 0, "user", "Gone."))
    found = run(spark, rows, tmp_path_factory)
    assert found == brute(rows)
    assert found[dropped] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_long_conversations_in_short_stretches(spark, tmp_path_factory, monkeypatch):
    """A conversation over many stretches, runs of equal rows dealt out in pieces, few rules."""
    monkeypatch.setattr(structure, "SEGMENT", 5)
    monkeypatch.setattr(structure, "RUN", 3)
    monkeypatch.setattr(structure, "RULE_SHARE", 8)
    rows = some_rows(2, 5, 90) + [(50, 2, "user", "One of many.")] * 40 + [(50, 3, "assistant", " ")] * 20
    assert run(spark, rows, tmp_path_factory) == brute(rows)


def test_an_empty_table(spark, tmp_path_factory):
    assert run(spark, [], tmp_path_factory) == {}


def test_rules_share_their_matrices():
    """A long string's matrix is that of its rules, and equal to the one symbol by symbol."""
    rng = random.Random(4)
    text = "".join(rng.choice(structure.TERMINALS) for _ in range(6)) * 40
    rules = []
    for _ in range(12):
        counts = structure.Counter()
        structure.count_pairs(structure.Grammar(rules).compress(text), 1, counts)
        if not counts:
            break
        rules.append(max(counts, key=lambda p: (counts[p], p)))
    grammar, plain = structure.Grammar(rules), structure.Grammar([])
    short = grammar.compress(text)
    assert len(short) < len(text) / 8
    assert grammar.close(grammar.run(None, text)) == plain.close(plain.run(None, text))


def test_rules_are_those_of_adding_the_most_frequent_pair(spark):
    """Round by round and one by one give grammars of the same strings."""
    texts = ["".join(random.Random(i).choice("!\"#") for _ in range(20)) for i in range(40)]
    rows = spark.createDataFrame([(t, 1) for t in texts], "symbols string, n long")
    rules = structure.learn(rows, share=20)
    assert 0 < len(rules) <= 20
    grammar = structure.Grammar(rules)
    spell = {c: c for c in structure.TERMINALS}
    for pair, name in grammar.rules.items():
        spell[name] = spell[pair[0]] + spell[pair[1]]
    for t in texts:
        assert "".join(spell[c] for c in grammar.compress(t)) == t
    left = structure.Counter()
    for t in texts:
        structure.count_pairs(grammar.compress(t), 1, left)
    assert max(left.values()) < max(2, 800 / 20)


@pytest.mark.parametrize("run_length", [1, 2, 3, 4, 5])
def test_pairs_of_a_run_do_not_overlap(run_length):
    counts = structure.Counter()
    structure.count_pairs("!" * run_length, 3, counts)
    assert counts["!!"] == 3 * (run_length // 2)


def test_texts_of_the_repaired_turns(spark):
    rows = spark.createDataFrame([(1, 0, "assistant", "Hi."), (1, 1, "user", "x"), (1, 2, "assistant", "Ok.")],
                                 "conv_id int, turn int, role string, text string")
    audits, turns = structure.repair(rows.withColumn("turn", F.col("turn").cast("long")))
    assert audits.first().audit == "IKKK" and audits.first().cost == 6
    assert [(r.role, r.text) for r in turns.orderBy("at").collect()] == [
        ("user", ""), ("assistant", "Hi."), ("user", "x"), ("assistant", "Ok.")]
