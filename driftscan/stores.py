"""Files and folders where they lie: local or mounted file systems, or stores that Arrow's file systems reach.

Tasks and the driver open paths by themselves here, where Spark's own readers
and writers have no format for what is inside.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyarrow import fs

#: What Arrow's file systems open beside local paths.
STREAMED = ("s3", "s3a", "gs", "gcs", "abfs", "abfss", "hdfs")
_OTHER_NAMES = {"s3a": "s3", "gcs": "gs"}


def is_local(path: str) -> bool:
    return path.startswith("/") or path.startswith("file:")


def local(path: str) -> str:
    return path.removeprefix("file://").removeprefix("file:")


def file_system(path: str) -> tuple[fs.FileSystem, str, str]:
    """The file system of a path, the path within it, and the prefix of all its paths."""
    if is_local(path):
        return fs.LocalFileSystem(), local(path), ""
    scheme, sep, rest = path.partition("://")
    if not sep:
        raise ValueError(f"not a path: {path}")
    store, inner = fs.FileSystem.from_uri(_OTHER_NAMES.get(scheme, scheme) + sep + rest)
    return store, inner, path.removesuffix(inner)


def open_file(path: str):
    """A binary file object with seek. Local files are not buffered, so that nothing but what is asked for is read."""
    if is_local(path):
        return open(local(path), "rb", buffering=0)
    store, inner, _ = file_system(path)
    return store.open_input_file(inner)


def files_below(path: str, wanted: Callable[[str], bool] = lambda name: True) -> list[str]:
    """Paths of the wanted files at or below path, in order; path itself if it is a file."""
    store, inner, prefix = file_system(path)
    at = store.get_file_info(inner)
    below: Iterable[fs.FileInfo] = [at] if at.type == fs.FileType.File else store.get_file_info(fs.FileSelector(inner, recursive=True))
    return sorted(prefix + f.path for f in below if f.type == fs.FileType.File and wanted(f.base_name))


class Publication:
    """Things made below `{root}/.staging-{run}` that take their names in root together.

    What bears a name already is moved to `{root}/.replaced-{run}` first, and back
    if anything fails, so that at every moment the old or the new one is whole.
    Names may have folders. The file system must be able to rename.
    """

    def __init__(self, root: str, run: str):
        self.store, self.root, _ = file_system(root.rstrip("/"))
        self.staging, self.replaced = f"{self.root}/.staging-{run}", f"{self.root}/.replaced-{run}"
        self._folders: set[str] = set()

    def exists(self, path: str) -> bool:
        return self.store.get_file_info(path).type != fs.FileType.NotFound

    def write(self, name: str, data: bytes, attempt: str) -> None:
        """A small file in the staging folder, whole or not at all; attempts that write the same one do not meet.

        It is made in a folder of the attempt's own: tasks that all make files in
        one folder wait for each other, and what a lost one leaves must not be published.
        """
        path, own = f"{self.staging}/{name}", f"{self.staging}/.{attempt}"
        for folder in (path.rpartition("/")[0], own):
            if folder not in self._folders:
                self.store.create_dir(folder, recursive=True)
                self._folders.add(folder)
        made = f"{own}/{name.replace('/', '%')}"
        with self.store.open_output_stream(made, compression=None) as f:
            f.write(data)
        self.store.move(made, path)

    def publish(self, names: dict[str, str]) -> None:
        """Each staged path (of keys) becomes its name (of values) in root."""
        moved: list[tuple[str, str]] = []

        def move(old: str, new: str) -> None:
            self.store.create_dir(new.rpartition("/")[0], recursive=True)
            self.store.move(old, new)
            moved.append((old, new))

        try:
            for staged, name in names.items():
                if self.exists(f"{self.root}/{name}"):
                    move(f"{self.root}/{name}", f"{self.replaced}/{name}")
                move(f"{self.staging}/{staged}", f"{self.root}/{name}")
        except BaseException:
            for old, new in reversed(moved):
                self.store.move(new, old)
            raise
        self.clear()

    def clear(self) -> None:
        for path in (self.staging, self.replaced):
            if self.exists(path):
                self.store.delete_dir(path)
