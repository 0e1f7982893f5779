"""Modification times of lake files, for checks that depend on them."""


def set_times(spark, root, instant):
    """Give every file below ``root`` one modification time."""
    Path = spark._jvm.org.apache.hadoop.fs.Path
    files = Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    listed = files.listFiles(Path(root), True)
    while listed.hasNext():
        files.setTimes(listed.next().getPath(), int(instant.timestamp() * 1000), -1)
