"""File systems of paths."""


def file_system(spark, path):
    """The Hadoop file system of a path, and the path."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place
