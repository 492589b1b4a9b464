import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).parents[1]

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from corpusmill.plans import build
import json

class Site:
    def get(self, url):
        pack = {{"id": 1, "title": "t", "questions": 1, "editors": [], "tours": [{{"questions": [{{"id": 11, "text": "Вопрос " * 9, "answer": "да"}}]}}]}}
        if "/pack/" in url:
            return "<script>self.__next_f.push([1," + json.dumps(json.dumps({{"pack": pack}})) + "])</script>"
        return '<a href="/pack/1">p</a>' if "page" not in url else ""

sys.exit(build.main([{house!r}], Site))
"""


def test_the_command_line_sends_its_code_to_the_workers(tmp_path):
    """Workers in processes of their own, in a folder without the package and with no path to it."""
    (tmp_path / "run.py").write_text(SCRIPT.format(root=str(ROOT), house=str(tmp_path / "house")))
    env = {"PATH": "/usr/bin:/bin", "SPARK_LOCAL_IP": "127.0.0.1", "PYSPARK_PYTHON": sys.executable, "PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.ui.enabled=false --conf spark.sql.shuffle.partitions=2 pyspark-shell", "HOME": str(tmp_path)}
    import os

    env |= {k: os.environ[k] for k in ("JAVA_HOME", "SPARK_HOME", "PATH") if k in os.environ}
    done = subprocess.run([sys.executable, str(tmp_path / "run.py")], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-3000:]
    assert "new: 1" in done.stdout and "questions: 1" in done.stdout
