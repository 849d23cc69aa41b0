"""Property tests: Spark expressions and operators against plain-Python brute force."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tiermill.functions import format_percent, format_thousands, mask_id
from tiermill.operators import ranking as R

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
QT = "qt_beneficiarios_ativos"


def py_thousands(n: int) -> str:
    return f"{n:,}".replace(",", ".")


def py_percent(x: float, places: int) -> str:
    return f"{x:.{places}f}%".replace(".", ",")


@SETTINGS
@given(st.lists(st.integers(min_value=-(10**15), max_value=10**15), min_size=1, max_size=30),
       st.lists(st.floats(min_value=0, max_value=100, allow_nan=False), min_size=1, max_size=30))
def test_formatting_matches_python(spark, ints, floats):
    df = spark.createDataFrame([(i,) for i in ints], "n long")
    assert [r[0] for r in df.select(format_thousands("n")).collect()] == [py_thousands(i) for i in ints]
    fd = spark.createDataFrame([(f,) for f in floats], "p double")
    got = [tuple(r) for r in fd.select(format_percent("p", 2), format_percent("p", 1)).collect()]
    assert got == [(py_percent(f, 2), py_percent(f, 1)) for f in floats]


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.text(alphabet="0123456789ab", max_size=16)), min_size=1, max_size=20))
def test_mask_matches_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(mask_id("v")).collect()]
    assert got == [None if v is None else v[:8] + "******" for v in values]


rows_strategy = st.lists(
    st.tuples(st.text(alphabet="abc", min_size=1, max_size=3), st.integers(min_value=0, max_value=5)),
    min_size=0, max_size=60, unique_by=lambda r: r[0],
)


@SETTINGS
@given(rows_strategy, st.integers(min_value=1, max_value=7), st.integers(min_value=-2, max_value=20))
def test_positions_and_paging_match_sorting(spark, rows, size, number):
    df = spark.createDataFrame(rows, f"cd_municipio string, {QT} long").repartition(3)
    ranked = R.with_position(df, R.order_desc(QT, ["cd_municipio"]))
    got = sorted((r.posicao, r.cd_municipio) for r in ranked.collect())
    expected = sorted(rows, key=lambda r: (-r[1], r[0]))
    assert got == [(i + 1, r[0]) for i, r in enumerate(expected)]
    n_pages = max(1, -(-len(rows) // size))
    page_no = min(max(number, 1), n_pages)
    out = sorted(r.posicao for r in R.page(ranked, number, size).collect())
    lo = (page_no - 1) * size + 1
    assert out == list(range(lo, min(lo + size - 1, len(rows)) + 1))
