"""Property test: js_regex + Java rlike agrees with a JavaScript-equivalent
reference on ASCII inputs.

Python's ``re`` with ASCII and IGNORECASE flags matches JavaScript's ``i``
regexes on ASCII text for the constructs generated here (``\\b`` and ``\\s``
are ASCII in both), except ``$``, which is mapped to ``\\Z`` (absolute end,
as in JavaScript).  Examples are evaluated in batches: one Spark job per
hypothesis example.
"""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from boardlake.functions.jscompat import js_regex

ATOMS = ["a", "b", "A", "x", " ", "-", "1", r"\s", r"\S", r"\d", r"\w", r"\b", ".", "[ab]", "[^a ]", "[a-c]", "^", "$"]
QUANT = ["", "", "", "*", "+", "?", "{1,2}"]


@st.composite
def patterns(draw):
    branches = []
    for _ in range(draw(st.integers(1, 2))):
        parts = []
        for _ in range(draw(st.integers(1, 4))):
            atom = draw(st.sampled_from(ATOMS))
            q = draw(st.sampled_from(QUANT)) if atom not in (r"\b", "^", "$") else ""
            parts.append(atom + q)
        branches.append("".join(parts))
    return "|".join(branches)


texts = st.text(alphabet="abAxB1 -\n\t_", max_size=12)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.too_slow, HealthCheck.data_too_large])
@given(st.lists(st.tuples(patterns(), texts), min_size=40, max_size=40))
def test_js_regex_matches_reference_semantics(spark, pairs):
    rows = [(i, js_regex(p), s) for i, (p, s) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "i int, p string, s string")
    got = {r["i"]: r["m"] for r in df.selectExpr("i", "s rlike p AS m").collect()}
    for i, (p, s) in enumerate(pairs):
        expected = re.search(p.replace("$", r"\Z"), s, re.ASCII | re.IGNORECASE) is not None
        assert got[i] == expected, (p, s, js_regex(p))
