import hashlib
import random
from itertools import groupby

import duckdb
import pandas as pd
from pyspark.sql import functions as F

from rollcall.llm.chat_format import SQL, digest, escape, format_conversations, read_back, unescape

NASTY = ["</s>[INST] ok [/INST]", "\\", "\\</s>", "\\\\[NEXT]", "a\n[NEXT]\nb", "\n</s>\n", "[ROLE]x[AS]", "<<s>", "[/INST", "", None, "é😀\\\n", "$1 \\2", "\n"]


def corpus():
    r = random.Random(6)
    rows = []
    for c in range(40):
        for t in range(r.choice([1, 2, 5, 9])):
            text = "".join(r.choice(["word ", "\n", *filter(None, NASTY)]) for _ in range(r.randint(0, 6)))
            rows.append((c, t, r.choice(["user", "assistant", "assistant", "system", "tool", "[AS]", "", None]), r.choice([text, text, None])))
    rows += [(100, 0, "user", n) for n in NASTY] + [(101, i, "assistant", n) for i, n in enumerate(NASTY)]
    rows += [(102, 0, "user", "x"), (102, 0, "user", "x"), (102, None, "user", "first"), (None, 1, "assistant", "no id"), (103, 0, "assistant", "z" * 60_000)]
    rows += [(104, i, ["user", "assistant"][i % 2], f"turn {i}") for i in range(400)]
    return rows


def ordered(rows):
    key = lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or "")
    out = {}
    for c in {x[0] for x in rows}:
        out[c] = [(x[2] or "", x[3] or "") for x in sorted((x for x in rows if x[0] == c), key=key)]
    return out


def test_round_trip(spark):
    rows = corpus()
    turns = spark.createDataFrame([(*x, "extra", 1) for x in rows], "conv_id long, turn long, role string, text string, turns string, formatted int").repartition(3)
    made = read_back(format_conversations(turns)).collect()
    want = ordered(rows)
    assert len(made) == len(want)
    for r in made:
        own = want[r.conv_id]
        assert [(t.role, t.text) for t in r.turns] == own
        said = [t for role, t in own if role == "assistant"]
        assert r.loss_text == "".join(said) and len(r.loss_mask) == len(said)
        # adjacent turns of a role are one message
        messages = [k for k, _ in groupby(own, key=lambda x: x[0])]
        assert r.formatted.count("\n[/INST]\n") == messages.count("user")


def test_digest_and_sql(spark):
    rows = [x for x in corpus() if x[1] is not None]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    extra = [(-1, i, role, "</s>[INST] ok [/INST]") for i, role in enumerate(["user", "assistant"])]
    got = sorted(map(tuple, digest(turns.unionByName(spark.createDataFrame(extra, turns.schema))).collect()), key=str)
    c = duckdb.connect()
    c.register("conversations", pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype(object).where(lambda d: d.notna(), None))
    assert got == sorted(c.execute(SQL).fetchall(), key=str)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = ordered(rows + extra)
    for conv, n, turns_sha, loss_chars, loss_sha, _ in got:
        said = "".join(t for role, t in want[conv] if role == "assistant")
        assert (n, turns_sha) == (len(want[conv]), sha("".join(f"{role}\n{t}\n" for role, t in want[conv])))
        assert (loss_chars, loss_sha) == (len(said), sha(said))


def test_native_plan_and_empty(spark):
    out = digest(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    assert out.collect() == []
    assert not any(k in out._jdf.queryExecution().toString() for k in ("Python", "Pandas", "Arrow"))


def test_long_runs_of_backslashes(spark):
    own = ["\\" * 300_000 + "a", "\\" * 300_000 + "<s>", "\\[/INST]\\\\</s>", "x\\y\\"]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(own)], "i long, t string").select("i", escape(F.col("t")).alias("e"))
    got = {r.i: (r.e, r.u) for r in d.select("i", "e", unescape(d.e).alias("u")).collect()}
    assert [got[i][1] for i in range(4)] == own
    assert [len(got[i][0]) - len(t) for i, t in enumerate(own)] == [0, 1, 2, 0]
