import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parent.parent


def test_entry_runs(spark, data):
    assert entry.entry(spark).limit(1).count() == 1


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 80


def test_nothing_but_the_entry_point_names_the_text_subpackage():
    for p in (ROOT / "erario").rglob("*.py"):
        if "llm" not in p.relative_to(ROOT).parts:
            assert "erario.llm" not in p.read_text(), p


def test_core_queries_need_no_text_subpackage():
    code = "import sys; sys.modules['erario.llm'] = None; import __spark_entry__ as e; assert 'p3_found' in e.queries() and 'p7_ids' not in e.queries()"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


def test_intermediates_are_dropped_when_the_driver_ends(spark, tmp_path):
    from erario.session import drop_on_exit

    path = f"file://{tmp_path}/consulta"
    drop_on_exit(spark, path)  # named before anything is written
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    spark.range(3).write.parquet(f"{path}/t")
    assert fs.cancelDeleteOnExit(p) and spark.read.parquet(f"{path}/t").count() == 3
