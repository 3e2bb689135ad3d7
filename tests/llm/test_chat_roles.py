"""Roles stay as they are in rows of turns, and get their common names in layouts that say who speaks."""

import hashlib
import json

from featuremart.llm import chat
from featuremart.llm.queries import QUERIES


def test_roles_of_rows_stay(spark, tmp_path):
    roles = ["human", "gpt", "assistant", "model", None, "bot", "prompter", "user"]
    rows = [(1, i, role, f"text {i}") for i, role in enumerate(roles)]
    rows += [(None, 0, "assistant", "a"), (None, 1, "gpt", None)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(
        str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: r for r in QUERIES["op5_chat"](spark, str(tmp_path)).collect()}
    for conv in (1, None):  # null ids are one conversation
        turns = [(role or "", text or "") for c, _, role, text in rows if c == conv]
        assert got[conv].n_turns == len(turns)
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        loss = "".join(t for r, t in turns if r == "assistant")
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_speakers_get_their_common_names(spark):
    record = {"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]}
    rows = spark.createDataFrame([(json.dumps(record),)], "payload string")
    assert [t.role for t in chat.canonical_turns(rows).first().turns] == ["user", "assistant"]
