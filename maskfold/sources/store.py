"""Names and files on the shared store, through the file system that Spark itself uses for a path."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Store:
    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(path).getFileSystem(self._conf)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def remove(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def rename(self, old: str, new: str) -> None:
        """Moves a folder or file to a free name, whose parents are made."""
        to = self._path(new)
        self._fs.mkdirs(to.getParent())
        if self._fs.exists(to) or not self._fs.rename(self._path(old), to):
            raise OSError(f"could not rename {old} to {new}")

    def files(self, folder: str, prefix: str = "") -> list[str]:
        """Paths of the files of a folder, by name."""
        found = [s.getPath() for s in self._fs.listStatus(self._path(folder)) if s.isFile()]
        return [p.toString() for p in sorted(found, key=lambda p: p.getName()) if p.getName().startswith(prefix)]

    def touch(self, path: str) -> None:
        self._fs.create(self._path(path), True).close()

    def write_text(self, path: str, text: str) -> None:
        out = self._fs.create(self._path(path), True)
        out.write(bytearray(text.encode()))
        out.close()

    def read_text(self, path: str) -> str:
        source = self._fs.open(self._path(path))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(source)).decode()
        finally:
            source.close()

    def joined(self, parts: list[str], whole: str) -> None:
        """One file of several, in order. Where the store can put files together by name (HDFS) no byte is moved;
        elsewhere they are copied one after the other as a stream, a buffer at a time."""
        to = self._path(whole)
        if self._fs.hasPathCapability(to, "fs.capability.paths.concat"):
            self.touch(whole)
            array = self._jvm.java.lang.reflect.Array.newInstance(to.getClass(), len(parts))
            for i, part in enumerate(parts):
                array[i] = self._path(part)
            self._fs.concat(to, array)
            return
        out = self._fs.create(to, True)
        try:
            for part in parts:
                source = self._fs.open(self._path(part))
                try:
                    self._jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, 1 << 20, False)
                finally:
                    source.close()
        finally:
            out.close()

    def joined_parquet(self, parts: list[str], whole: str) -> None:
        """One Parquet file with the row groups of several of one schema, in order. Their pages are copied as they are,
        as a stream; only the footers are read and made anew."""
        hadoop = self._jvm.org.apache.parquet.hadoop
        reader = hadoop.ParquetFileReader.open(self._source(parts[0]))
        try:
            footer = reader.getFooter().getFileMetaData()
        finally:
            reader.close()
        to = hadoop.util.HadoopOutputFile.fromPath(self._path(whole), self._conf)
        group, padding = hadoop.ParquetWriter.DEFAULT_BLOCK_SIZE, hadoop.ParquetWriter.MAX_PADDING_SIZE_DEFAULT
        out = hadoop.ParquetFileWriter(to, footer.getSchema(), hadoop.ParquetFileWriter.Mode.CREATE, group, padding)
        try:
            out.start()
            for part in parts:
                out.appendFile(self._source(part))
            out.end(footer.getKeyValueMetaData())
        finally:
            out.close()

    def _source(self, path: str):
        return self._jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(self._path(path), self._conf)
