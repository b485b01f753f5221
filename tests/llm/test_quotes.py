import duckdb
from pyspark.sql import functions as F

from coverlay.llm import quotes as Q
from tests.test_oracle import _text

A = "The first message has this long line.\nAnd a second line of text."
ROWS = [
    (1, 0, "user", A),
    (1, 1, "assistant", "On Monday, A wrote:\n> The first  message has this long line.\n> And a second line of text.\n\nThis answers the first message."),
    (1, 2, "user", "An aside without quotes here."),
    (1, 3, "user", "> This answers the first message.\n>> the first message HAS this long line.\nMy answer to the answer is long."),
    (1, 4, "assistant", " > An aside without quotes here.\n\t> > And a second line of text.\nLate reply to the aside."),
    (1, 5, "user", "> short\n> nobody ever wrote this sentence\nno link"),
    (1, 6, "user", "> The future sentence comes later.\nquotes what comes later"),
    (1, 7, "user", "The future sentence comes later."),
    (1, 8, "user", "> This answers the first message.\n> An aside without quotes here.\nties by size, then turn"),
    (2, 0, "user", "> The first message has this long line.\nanother conversation"),
    (2, 1, "user", ""), (2, 2, None, None), (2, 3, "user", ">"), (2, 3, "user", ">"), (2, 3, "system", "same turn, other text"),
    (2, 4, "user", "\r\n\t tabs and separators stay \x85\n>> deep > marks stay out\n"), (2, 5, "user", "On A wrote:\nno quote follows"),
    (None, 0, "user", A), (None, None, "user", "> The first message has this long line."), (3, None, "user", "x"), (3, 1, "user", "y"),
    *[(4, i, "user", f"> line number {i - 1} of the chain\nline number {i} of the chain") for i in range(40)],
    (5, 0, "user", "word " * 40_000), (5, 1, "user", ("> " + "word " * 40_000 + "\n") * 3 + "> > x\n" * 20_000 + "done"),
    *[(6, i, "user", "> the same common line\nthe same common line") for i in range(200)],
]


def test_against_sql(spark, monkeypatch):
    ddl = "conv_id long, turn long, role string, text string"
    messages = spark.createDataFrame(ROWS, ddl)
    con = duckdb.connect()
    pdf = messages.toPandas()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", ROWS)
    assert len(pdf) == len(ROWS)
    clash = messages.withColumns({"conv": F.lit(1), "position": F.lit(2), "root": F.lit("r"), "n": F.lit(3), "parent": F.lit(0)})
    got = Q.conversations(clash)
    cols = ["conv_id", "turn", "role", "text", "reply_to", "root", "depth", "position"]
    assert got.columns == cols
    rows = [tuple(r) for r in got.collect()]
    result = con.execute(Q.SQL)
    assert [d[0] for d in result.description] == cols
    want = result.fetchall()
    # nulls sort last in DuckDB and first in Spark: positions of groups with a null turn are checked below
    free = lambda rs: sorted(tuple(map(_text, r)) for r in rs if r[0] != 3 and r[0] is not None)
    assert free(rows) == free(want)
    assert sorted((_text(r[1]), r[7]) for r in rows if r[0] == 3) == [("1", 1), ("~", 0)]
    by = {(r[0], r[1]): r for r in rows}
    assert by[1, 1][3] == "This answers the first message." and by[1, 1][4] == 0
    assert by[1, 3][4] == 1 and by[1, 4][4] == 2 and by[1, 5][4] is None and by[1, 6][4] is None and by[1, 8][4] == 1
    assert by[1, 3][5:7] == (0, 2) and by[4, 39][5:7] == (0, 39)
    assert by[2, 1][3] == "" and by[2, 2][3] is None and by[2, 3][7] == 3 and by[2, 4][7] == 6


def test_links_and_empty(spark):
    messages = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string")
    deep = Q.quotation_links(messages).where("conv = 1 AND level = 2")
    assert sorted((r.turn, r.original) for r in deep.collect()) == [(3, 0), (4, 0)]
    assert Q.conversations(messages.limit(0)).count() == 0
    plan = Q.conversations(messages)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
