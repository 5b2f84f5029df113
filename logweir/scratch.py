"""Where a query that writes and reads back puts its files."""

from __future__ import annotations

import shutil
import uuid

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"
#: Without the setting: a folder on the session's default file system.
_DEFAULT = "/tmp/logweir"


def scratch_dir(spark: SparkSession) -> str:
    """A new folder under the shared one the session names.

    Without that setting a local session gets one on its default file system; a
    cluster gets an error, since its executors may not share that.
    """
    shared = spark.conf.get(_SETTING, None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError(f"set {_SETTING} to a folder that all executors share")
        shared = _DEFAULT
    return f"{shared.rstrip('/')}/logweir-{uuid.uuid4().hex}"


def remove_scratch(path: str) -> bool:
    """Remove a folder that ``scratch_dir`` gave, once its frames are no longer read.

    Only on a local file system; elsewhere nothing is done and False is returned, and
    the storage's own expiry has to do it.
    """
    local = path.removeprefix("file://").removeprefix("file:")
    if "logweir-" not in local or not local.startswith("/"):
        return False
    shutil.rmtree(local, ignore_errors=True)
    return True
