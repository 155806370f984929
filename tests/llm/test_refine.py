import random
import string
import unicodedata
from collections import defaultdict

from pyspark.sql import functions as F

from ledgerloom.llm import refine

SCHEMA = "record_id bigint, report_id string, grid array<array<string>>, key string, k bigint, table_key string, content_hash string"


def tidy(s):
    return "".join(c for c in (s or "").lower() if not c.isspace() and unicodedata.category(c)[0] not in "PZ")


def brute(rows):
    groups = defaultdict(list)
    for i, rep, grid, *_ in rows:
        if grid:
            width = max(len(r or []) for r in grid)
            cols = sorted(tuple(tidy(r[c]) if r and c < len(r) else "" for r in grid) for c in range(width))
            groups[tidy(rep), len(grid), tuple(cols)].append(i)
    return {(min(g), i) for g in groups.values() if len(g) > 1 for i in g}


def dressed(rng, grid):
    order = list(range(len(grid[0])))
    rng.shuffle(order)
    touch = lambda s: rng.choice(["", " ", "* "]) + rng.choice([s, s.upper(), s.lower(), s.replace(" ", " ")]) + rng.choice(["", ";", "\n", ":"])
    return [[touch(r[c]) for c in order] for r in grid]


def test_against_brute_force(spark):
    rng, rows = random.Random(2), []
    base = [[[rng.choice(["Cộng", "Vay", "1.234", "(5)", "", "a b"]) for _ in range(w)] for _ in range(h)] for w, h in [(1, 1), (2, 3), (3, 2), (4, 5)] * 12]
    for g in base:
        for _ in range(rng.randint(1, 4)):
            rows.append([dressed(rng, g), rng.choice(["R_1", "r 1", "R_2"])])
    near = [list(map(list, g)) for g in base[:10]]
    for g in near:
        g[0][0] += "x"
        rows.append([g, "R_1"])
    rows += [[None, "R_1"], [[], "R_1"], [[[]], "R_1"], [[[]], "R_1"], [[["a"], []], None], [[["A"], [""]], ""], [[[None]], "R"], [[[""]], "r"]]
    data = [(i, rep, g, "clash", 0, "t", "h") for i, (g, rep) in enumerate(rows)]
    df = spark.createDataFrame(data, SCHEMA)
    got = [(r.group_id, r.record_id) for r in refine.copies(df).collect()]
    want = brute([(i, rep, g) for i, rep, g, *_ in data])
    assert len(got) == len(set(got)) and set(got) == want
    kept = {r.record_id: r.n_copies for r in refine.collapsed(df).collect()}
    assert sum(kept.values()) == len(data) and set(kept) == set(range(len(data))) - {i for g, i in want if g != i}


def test_empty_table_and_long_cells(spark):
    df = spark.createDataFrame([(1, "r", [["x" * 200_000]], "", 0, "", ""), (2, "r", [["X" * 200_000]], "", 0, "", "")], SCHEMA)
    assert sorted((r.group_id, r.record_id, r.n_copies) for r in refine.copies(df).collect()) == [(1, 1, 2), (1, 2, 2)]
    assert refine.copies(df.limit(0)).count() == 0


def test_a_third_of_all_rows_in_one_group(spark):
    word = F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.concat(F.lit("row "), F.col("id").cast("string")))
    df = spark.range(30_000).select(F.col("id").alias("record_id"), F.lit("r").alias("report_id"), F.array(F.array(word)).alias("grid"))
    got = refine.copies(df).agg(F.count("*").alias("n"), F.countDistinct("group_id").alias("g"), F.max("n_copies").alias("m")).first()
    assert (got.n, got.g, got.m) == (10_000, 1, 10_000)


def test_invariants_agree_with_the_key(spark):
    """No formatting difference may change the cheap key."""
    rng = random.Random(4)
    grid = [["".join(rng.choices(string.ascii_letters + " .,", k=6)) for _ in range(3)] for _ in range(4)]
    rows = [(i, "r", dressed(rng, grid), "", 0, "", "") for i in range(20)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert df.select(refine.invariants(F.col("report_id"), F.col("grid")).alias("k")).distinct().count() == 1
    assert df.select(refine.column_key(F.col("report_id"), F.col("grid")).alias("k")).distinct().count() == 1
