"""The library where the executors have no copy of it, and the registry where optional modules are missing."""

import os
import subprocess
import sys

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def run(code, cwd):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    return subprocess.run([sys.executable, "-c", code], cwd=cwd, env=env, capture_output=True, text=True, timeout=300)


def test_tasks_need_no_copy_of_the_library(tmp_path):
    (tmp_path / "a.csv").write_text('source_row_id,ip,hostname,fqdn,mac,owner,device_type,site,notes\n1,10.0.0.1,h,,,,,,"two\nlines"\n')
    code = f"""
import sys
sys.path.insert(0, {HERE!r})
from netgroom import clean_inventory, read_raw
from netgroom.operators.payload import owner_payloads
from netgroom.session import local_session
spark = local_session("elsewhere", 2)
raw = read_raw(spark, {str(tmp_path)!r} + "/")
print(raw.first().notes.split(), owner_payloads(clean_inventory(raw)).count())
"""
    done = run(code, tmp_path)
    assert "['two', 'lines'] 1" in done.stdout, done.stderr[-2000:]


def test_a_missing_module_leaves_the_other_queries(tmp_path):
    for module in ("ahocorasick", "public_tokenizers", "regex", "corpus_pipeline"):
        code = f"""
import sys
sys.modules[{module!r}] = None
sys.path.insert(0, {HERE!r})
import __spark_entry__ as e
names = set(e.queries())
print(len([n for n in names if n.startswith("q_")]) >= 52, any(n.startswith("op") for n in names), set(e.oracle_sql()) <= names)
"""
        done = run(code, tmp_path)
        assert "True False True" in done.stdout, done.stderr[-2000:]
