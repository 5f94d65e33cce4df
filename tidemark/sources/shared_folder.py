"""Where jobs put tables that must outlive the executors that wrote them."""

import tempfile
import uuid
from contextlib import contextmanager

#: Folders of local sessions that name none; Spark refuses to set one in a running session.
LOCAL = {}
#: Folders of the `scratch` blocks that are open, the inner ones last.
SCRATCH = []


def shared_folder(spark):
    """The folder named by `spark.checkpoint.dir`.

    A cluster must name one that all its machines see. Only a local session,
    as in tests, falls back to a temporary folder of this machine.
    """
    folder = (spark.conf.get("spark.checkpoint.dir", None)
              or spark.sparkContext.getConf().get("spark.checkpoint.dir"))
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    application = spark.sparkContext.applicationId
    if application not in LOCAL:
        LOCAL[application] = tempfile.mkdtemp(prefix="tidemark-")
    return LOCAL[application]


def new_path(spark, label):
    """A path under the shared folder that no other run uses."""
    folder = SCRATCH[-1] if SCRATCH else shared_folder(spark)
    return f"{folder}/{label}-{uuid.uuid4().hex}"


def stored(df, label):
    """Write `df` once and return it read back.

    For a result that several later queries start from: unlike cached blocks,
    the table survives lost executors and needs no recomputation.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark):
    """Inside, new paths lie in a folder of their own, which is deleted at the end.

    For a job whose result is written elsewhere before the block ends: what is only planned
    there still reads the stored tables.
    """
    folder = new_path(spark, "scratch")
    SCRATCH.append(folder)
    try:
        yield folder
    finally:
        SCRATCH.remove(folder)
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
