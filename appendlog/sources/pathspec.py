"""The ``path`` option: a literal directory and a base-name regex.

``path`` is cut at its last ``/``: the left part is a directory, the right part
a regular expression that must match the whole base name.  The directory may
hold one ``{node}`` segment; every folder at that place is a node (one per
host on shared storage) and its name is the node label.  Without it there is a
single node, ``local``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

NODE_TOKEN = "{node}"
LOCAL_NODE = "local"


class AppendLogError(Exception):
    pass


@dataclass(frozen=True)
class PathSpec:
    path: str
    directory: str  # may contain {node}
    pattern: str
    prefix: str  # directory part before {node}, or the whole directory
    suffix: str  # directory part after {node} ("" or "/a/b")

    @property
    def has_node(self) -> bool:
        return NODE_TOKEN in self.directory

    def node_dir(self, node: str) -> str:
        if not self.has_node:
            return self.directory
        return f"{self.prefix}/{node}{self.suffix}"

    def file_path(self, node: str, name: str) -> str:
        return f"{self.node_dir(node)}/{name}"

    @property
    def glob(self) -> str:
        """Hadoop glob of all node folders (for Spark's file listing); the
        literal parts are escaped, only the node segment is a wildcard."""
        if not self.has_node:
            return _glob_escape(self.directory)
        return f"{_glob_escape(self.prefix)}/*{_glob_escape(self.suffix)}"

    @property
    def node_depth(self) -> int:
        """Position of the node segment counted from the base name (-2 = parent)."""
        return -2 - (self.suffix.count("/") if self.has_node else 0)

    def matches(self, name: str) -> bool:
        return _compiled(self.pattern).fullmatch(name) is not None


_GLOB_SPECIAL = re.compile(r"([\\{}\[\]*?])")


def _glob_escape(path: str) -> str:
    return _GLOB_SPECIAL.sub(r"\\\1", path)


_CACHE: dict[str, re.Pattern] = {}


def _compiled(pattern: str) -> re.Pattern:
    p = _CACHE.get(pattern)
    if p is None:
        p = _CACHE[pattern] = re.compile(pattern)
    return p


def parse_path(path: str | None) -> PathSpec:
    if not path:
        raise AppendLogError("option path not set")
    if path.startswith("file:"):
        path = path[len("file://"):] if path.startswith("file://") else path[len("file:"):]
    if "://" in path:
        raise AppendLogError(
            f"option path {path!r} is not a mounted POSIX path: growing files are read by byte range "
            "with POSIX calls on the driver and on every executor")
    directory, _, pattern = path.rpartition("/")
    if not pattern:
        raise AppendLogError(f"option path {path!r} has no file name pattern after the last '/'")
    if directory.count(NODE_TOKEN) > 1:
        raise AppendLogError(f"option path {path!r} holds more than one {NODE_TOKEN} segment")
    if NODE_TOKEN in directory:
        prefix, _, suffix = directory.partition(NODE_TOKEN)
        if not prefix.endswith("/") or (suffix and not suffix.startswith("/")):
            raise AppendLogError(f"{NODE_TOKEN} must be a whole path segment in {path!r}")
        prefix = prefix.rstrip("/")
    else:
        prefix, suffix = directory, ""
    _compiled(pattern)  # fail early on a bad regex
    return PathSpec(path=path, directory=directory, pattern=pattern, prefix=prefix, suffix=suffix)
