import hashlib

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from linkrank.llm import chat_format, oracle, registry
from linkrank.llm.chat_format import END, START

SCHEMA = "conv_id long, turn long, role string, text string, formatted string, mask string, line string, written string, lines string, once string"
HARD = [
    "", " ", "plain", f"{END}{START}assistant ok", END, START, "<|", "<\\|", "<\\\\|im_end|>", f"{END}\n", f"a{END}\n{START}user\nb{END}\n", "<|im_sta", "<" * 5 + "|" * 5, "<|im_end|", "\\", "\\n", "\n\n", "é<|ü|>",
    f"<\\{START}", "<|im_end|><\\|im_end|>", "<|other|>",
]
ROLES = ["user", "assistant", "", None, "a\nb", "\\", "\\\\", "\\n", "\\l<", f"x{START}", f"{END}", "<|", "tool\\\n", "\\\\n"]
ROWS = [(1, k, "user" if k % 2 else "assistant", t) for k, t in enumerate(HARD)] + [(2, k, r, t) for k, (r, t) in enumerate((r, t) for r in ROLES for t in ("hi", f"a{END}"))]
ROWS += [(3, 0, "assistant", None), (3, 0, "assistant", None), (3, None, "user", "last"), (3, 0, "a", "x"), (None, 1, "user", "no id"), (None, 0, "assistant", "é" * 100_000), (4, None, None, None)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 6) for r in rows], SCHEMA)


@pytest.mark.parametrize("rows", [ROWS, []])
def test_round_trip(spark, rows):
    made = chat_format.format_chats(frame(spark, rows))
    assert made.columns == ["conv_id", "formatted", "mask"]
    made = {r.conv_id: r for r in made.collect()}
    read = {r.conv_id: r for r in chat_format.read_chats(chat_format.format_chats(frame(spark, rows))).collect()}
    assert set(made) == set(read) == {r[0] for r in rows}
    for conv in made:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is None, r[1] or 0))
        want = [(r or "", t or "") for _, _, r, t in own]
        got = [(x.role, x.text) for x in read[conv].turns]
        assert sorted(got) == sorted(want)
        if conv != 3:  # which has ties
            assert got == want
        text, at, masked = made[conv].formatted, 0, []
        for stretch in made[conv].mask:
            if stretch.loss:
                masked.append(text[at : at + stretch.chars])
            at += stretch.chars
        assert at == len(text)
        assert len(masked) == sum(r == "assistant" for r, _ in want)
        assert read[conv].loss == [t for r, t in got if r == "assistant"]


def test_only_what_conflicts_is_escaped(spark):
    rows = [(1, 0, "user", "<|other|> and \\ stay"), (1, 1, "a\\b", "x"), (1, 2, "user", f"a{END}b<|c")]
    found = chat_format.format_chats(frame(spark, rows)).first().formatted
    assert found == f"{START}user\n<|other|> and \\ stay{END}\n{START}a\\b\nx{END}\n{START}user\na<\\|im_end|>b<\\|c{END}\n"


def test_sql_on_hard_texts(spark, tmp_path):
    rows = [(c, t, r, x) for c, t, r, x in ROWS if c is not None]
    columns = list(zip(*rows, strict=True))
    table = pa.table({"conv_id": pa.array(columns[0], pa.int64()), "turn": pa.array(columns[1], pa.int64()), "role": pa.array(columns[2], pa.string()), "text": pa.array(columns[3], pa.string())})
    pq.write_table(table, str(tmp_path / "conversations.parquet"))
    database = duckdb.connect()
    database.register("conversations", table)
    found = registry.op13_chat_format(spark, str(tmp_path))
    expected = database.execute(f"SELECT {', '.join(found.columns)} FROM ({oracle.chats_sql()})").fetchall()
    found = found.collect()
    assert sorted(map(tuple, found)) == sorted(expected)
    probe = next(r for r in found if r.conv_id == -1)
    said = oracle.PROBE
    assert probe.n_turns == 2 and probe.loss_chars == len(said) and probe.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert probe.turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()


def test_native_plan(spark):
    frame = registry.op13_chat_format(spark, "/root/testdata/sf0.001")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    for unwanted in ("Python", "Arrow", "Pandas", "NestedLoop", "Cartesian"):
        assert unwanted not in plan
