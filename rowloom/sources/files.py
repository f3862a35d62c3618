"""Files of any Hadoop file system, as streams of the driver's JVM: joined, digested and moved without being held in memory."""

from __future__ import annotations

from pyspark.sql import SparkSession

BUFFER = 1 << 20


class Files:
    """The file system that a path is on; paths without a scheme are on the default one."""

    def __init__(self, spark: SparkSession, folder: str):
        self._jvm, self._gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self.path(folder).getFileSystem(self._conf)
        self._fs.setWriteChecksum(False)

    def path(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join(parts))

    def exists(self, path: str) -> bool:
        return self._fs.exists(self.path(path))

    def is_file(self, path: str) -> bool:
        return self.exists(path) and self._fs.getFileStatus(self.path(path)).isFile()

    def qualified(self, path: str) -> str:
        """The path as scans report it."""
        return self.path(path).makeQualified(self._fs.getUri(), self._fs.getWorkingDirectory()).toString()

    def delete(self, path: str) -> None:
        self._fs.delete(self.path(path), True)

    def move(self, source: str, target: str) -> None:
        """Put a file in place of another in one step."""
        rename = self._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename")
        options = self._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = rename.getField("OVERWRITE").get(None)
        at, of = self.path(self.qualified(target)), self.path(self.qualified(source))
        self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), self._conf).rename(of, at, options)

    def _digest(self):
        return self._jvm.java.security.MessageDigest.getInstance("SHA-256")

    def joined(self, parts: str, target: str) -> str:
        """Write the part files of a folder, in the order of their names, into one file; the SHA-256 of what was written."""
        digest = self._digest()
        out = self._jvm.java.security.DigestOutputStream(self._fs.create(self.path(target), True), digest)
        try:
            names = sorted(s.getPath().getName() for s in self._fs.listStatus(self.path(parts)))
            for name in (n for n in names if n.startswith("part-")):
                self._copy(self.path(parts, name), out)
        finally:
            out.close()
        return bytes(digest.digest()).hex()

    def sha256(self, path: str) -> str | None:
        """The SHA-256 of a file's bytes; None for a missing file."""
        if not self.exists(path):
            return None
        digest = self._digest()
        out = self._jvm.java.security.DigestOutputStream(self._jvm.java.io.OutputStream.nullOutputStream(), digest)
        self._copy(self.path(path), out)
        return bytes(digest.digest()).hex()

    def _copy(self, path, out) -> None:
        content = self._fs.open(path)
        try:
            self._jvm.org.apache.hadoop.io.IOUtils.copyBytes(content, out, BUFFER, False)
        finally:
            content.close()

