"""Property tests (hypothesis): JVM-side column functions agree with their driver-side
twins on arbitrary text, and the laws of the name sanitiser hold."""

from hypothesis import given, settings
from hypothesis import strategies as st

from releasekit.functions import columns as C
from releasekit.functions.schema import sanitize_name

TEXT = st.text(alphabet=st.characters(codec="utf-8", exclude_categories=("Cs",)), max_size=24)


@settings(max_examples=40, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=50))
def test_slugify_matches_sanitize_name(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r.s for r in df.select(C.slugify("v").alias("s")).collect()]
    assert got == [sanitize_name(v) for v in values]


@settings(max_examples=200, deadline=None)
@given(TEXT)
def test_sanitize_idempotent_and_in_alphabet(v):
    s = sanitize_name(v)
    assert sanitize_name(s) == s
    assert all(ch.isdigit() or ("a" <= ch <= "z") or ch == "_" for ch in s)
    assert not s.endswith("_")


@settings(max_examples=30, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "", "c/d"]), max_size=5), min_size=1, max_size=20))
def test_url_tail_matches_python(spark, parts):
    urls = ["/".join(p) for p in parts]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = [r.t for r in df.select(C.url_tail("u").alias("t")).collect()]
    assert got == [u.split("/")[-1] for u in urls]
