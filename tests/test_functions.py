import pytest
from pyspark.sql import functions as F

from sparkreel import functions as fn

LETTERS = [
    ("(A) Yellow", "A"), ("A", "A"), ("The answer is C", "C"), ("Best Option: (A)", "A"), ("Option B", "B"), ("Is (b)", "B"),
    ("\t(c)\n", "C"), ("", None), (None, None), ("Apple", "A"), ("Best option A", "B"), ("answer: B", "A"), ("answers", "A"),
    ("option is", "I"), ("  d", "D"), ("zzz", None), ("　d", "D"),
]


def column(spark, values, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(make(F.col("v"))).collect()]


def test_option_letter(spark):
    assert column(spark, [t for t, _ in LETTERS], fn.option_letter) == [x for _, x in LETTERS]


def test_match_is_never_null(spark):
    rows = spark.createDataFrame([("(A) x", "A"), (None, None), ("zzz", "zzz"), ("B", None)], "p string, t string")
    assert [r[0] for r in rows.select(fn.answer_matches(F.col("p"), F.col("t"))).collect()] == [True, False, False, False]


def test_format_answer_and_question(spark):
    rows = spark.createDataFrame([("Yellow", ["Yellow", "Red"]), ("Red", ["Yellow", "Red", "Red"]), ("Pink", ["Yellow"])], "a string, c array<string>")
    got = rows.select(fn.format_answer(F.col("a"), F.col("c")), fn.format_question(F.lit("Q? "), F.col("c"))).collect()
    assert [r[0] for r in got] == ["(A) Yellow", "(B) Red", "Pink"]
    assert got[0][1] == "Question: Q? \nOptions:\n(A) Yellow\n(B) Red"


def test_conversation_has_a_place_for_frames(spark):
    row = spark.createDataFrame([("Q", ["x"])], "q string, c array<string>")
    m = row.select(fn.conversation(F.col("q"), F.col("c"), frames=F.array(F.lit(3))).alias("m")).first()["m"]
    assert [x["role"] for x in m] == ["system", "user"]
    assert m[1]["content"][0]["video"] == [3] and m[1]["content"][1]["text"].endswith("Only give the best option.")
    assert len(row.select(fn.conversation(F.col("q"), F.col("c"), include_system=False).alias("m")).first()["m"]) == 1


@pytest.mark.parametrize(
    ("path", "base", "want"),
    [("/d/M/video/1/a.mp4", "/d/M", "video/1/a.mp4"), ("/other/a.mp4", "/d/M", "/other/a.mp4"), ("/d/M2/x", "/d/M", "2/x"), ("//x", "", "x")],
)
def test_relative_path(spark, path, base, want):
    assert column(spark, [path], lambda c: fn.relative_path(c, base)) == [want]


def test_stem_and_names(spark):
    assert column(spark, ["/p/ego_35.mp4", "/p/a.tar.gz", "/p/.hidden", "plain", "/p/d/"], fn.stem) == ["ego_35", "a.tar", ".hidden", "plain", "d"]
    numbers = spark.createDataFrame([(1234,), (1234567,)], "n long")
    assert [r[0] for r in numbers.select(fn.frame_filename(F.col("n"))).collect()] == ["001234.jpg", "1234567.jpg"]
    assert column(spark, ["/abs", "rel"], lambda c: fn.join_path(F.lit("/v"), F.lit("t"), c)) == ["/abs", "/v/t/rel"]


def test_rates(spark):
    rows = spark.createDataFrame([(1, 31), (0, 0), (297, 87)], "p long, n long")
    assert [r[0] for r in rows.select(fn.rounded_rate(F.col("p"), F.col("n"))).collect()] == [0.0312, 0.0, 0.7734]
