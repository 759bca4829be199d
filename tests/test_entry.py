"""The driver's entry works with and without the text operators."""

import subprocess
import sys

from tests.conftest import ROOT


def test_entry_without_text_operators():
    code = "import sys; sys.modules['plumbline.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; q = e.queries(); assert q and not any(k.startswith('op') for k in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
