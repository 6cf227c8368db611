"""The other queries are there without the optional part, or a package that only it needs."""

import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("missing", [["public_tokenizers"], ["tokenizers", "xxhash"], ["textmart.llm", "corpus_pipeline"], ["corpus_pipeline"]])
def test_queries_without_the_optional_part(missing):
    code = f"import sys; sys.modules.update(dict.fromkeys({missing!r})); import __spark_entry__ as e; q = e.queries(); assert len(q) > 80 and 'fold_text' in q and set(e.oracle_sql()) <= set(q); print(len(q))"
    run = subprocess.run([sys.executable, "-c", code], cwd=REPO, capture_output=True, text=True)
    assert run.returncode == 0, run.stderr
