"""Task code travels to workers that do not have the package on their path."""

import subprocess
import sys
import textwrap

from conftest import SF_DIR

PROGRAM = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("__spark_entry__", "{{root}}/__spark_entry__.py")
contract = importlib.util.module_from_spec(spec)
spec.loader.exec_module(contract)
from verification.local import local_session
spark = local_session("elsewhere", "2")
print("rows", contract.queries()["sheet_scan"](spark, "{SF_DIR}").count())
"""


def test_sheet_scan_from_another_directory(pytestconfig, tmp_path):
    program = textwrap.dedent(PROGRAM).replace("{root}", str(pytestconfig.rootpath))
    done = subprocess.run([sys.executable, "-c", program], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "rows 1500" in done.stdout, done.stderr[-2000:]
