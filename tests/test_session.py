import subprocess
import sys
import textwrap


def test_shared_folder_comes_from_the_session(tmp_path):
    """A cluster that names spark.checkpoint.dir gets every shared table there."""
    code = textwrap.dedent(f"""
        import os
        from careweave.session import build_session, materialize, shared_dir
        spark = build_session("t", **{{"spark.master": "local[1]", "spark.ui.enabled": "false",
                                       "spark.checkpoint.dir": {str(tmp_path)!r}}})
        assert shared_dir(spark) == {str(tmp_path)!r}
        df = materialize(spark.range(5))
        assert df.count() == 5 and df.dtypes == [("id", "bigint")]
        assert all({str(tmp_path)!r} in f for f in df.inputFiles())
    """)
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120)
