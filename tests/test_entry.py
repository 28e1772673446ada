import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def _names(before: str) -> list[str]:
    code = f"import sys; {before}; import __spark_entry__ as e; print(*e.queries(), sep='\\n')"
    return subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True).stdout.split()


def test_without_a_library_of_the_subpackage_the_other_queries_remain():
    whole = _names("pass")
    for missing in ("tokenizers", "recon360.llm", "sentencepiece"):
        left = _names(f"sys.modules['{missing}'] = None")
        assert set(left) <= set(whole) and "bq1_revenue_by_month" in left
        assert not any(name.startswith("op") and name[2].isdigit() or name == "pipeline" for name in left)
