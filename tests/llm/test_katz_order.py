"""The registered query scores with two words of history."""

import pytest

from llm_cases import rows  # noqa: F401  fixtures
from test_katz import plain

from bazaarmill.llm import katz


def test_query_is_of_order_three(spark, rows, tmp_path):
    short = [(r[0], r[1][:1000] if r[1] else r[1]) for r in rows]
    spark.createDataFrame(short, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    key = lambda r: (-1 if r[0] is None else r[0], *r[1:5], round(r[5], 6))
    want = sorted(plain(short, 3)[0], key=key)
    got = sorted((tuple(r) for r in katz.op1_katz(spark, str(tmp_path)).collect()), key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert [r[6] for r in got] == pytest.approx([r[6] for r in want], abs=1e-6)
