import subprocess
import sys
from pathlib import Path

import __spark_entry__

ROOT = Path(__file__).resolve().parent.parent

HIDE = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name.startswith(("wayline.llm", "corpus_pipeline")):
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
print(len(e.queries()), any(n.startswith("op") or n == "pipeline" for n in e.queries()))
"""


def test_flagship_runs(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_the_rest_works_without_the_llm_folder():
    out = subprocess.run([sys.executable, "-c", HIDE], cwd=ROOT, capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) > 50 and out[1] == "False"
