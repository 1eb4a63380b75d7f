"""Option resolution (options plus ``spark.appendlog.*`` conf; conf wins)."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from appendlog.sources.pathspec import AppendLogError, PathSpec, parse_path

CONF_PREFIX = "spark.appendlog."

# Option keys and defaults that users of the source rely on.
INT_MAX = 2147483647
DEFAULTS = {
    "path": "",
    "starting.offsets": "earliest",
    "bytes.max": str(INT_MAX),
    "md5.check.enabled": "true",
    "md5.sample.length": "1024",
    "offset.backup.provider": "table",
}
# Options of our own.
EXTRA_DEFAULTS = {
    "offset.backup.path": "",  # folder of the table provider; default under spark.checkpoint.dir
    "split.bytes": str(128 << 20),  # ranges above this are cut into sub-ranges read in parallel
    "stream.name": "",  # tells streams over one path apart in the offset backup
    "bytes.batch": "0",  # byte budget of a whole batch, shared fairly by its files; 0: none
    "catalog": "driver",  # who lists and plans for a stream: its driver process, or Spark jobs ("manifest")
    "catalog.path": "",  # folder of the manifest; default under spark.checkpoint.dir
    "prefix.check.block": "0",  # bytes of the last committed block that is compared too; 0: heads only
    "identity.check": "false",  # follow renamed files by inode and head checksum
    "target.path": "",  # frozen end of a bounded run (set by run_available)
    "initial.offset.json": "",  # offset to start from when there is no checkpoint (set by read_stream)
}
KNOWN = set(DEFAULTS) | set(EXTRA_DEFAULTS)
POLICIES = ("earliest", "latest")
CATALOGS = ("driver", "manifest")

log = logging.getLogger("appendlog")


def resolve(spark, **options) -> dict[str, str]:
    """Merge options with every conf entry under the prefix; conf wins, exact case."""
    merged = {k: str(v) for k, v in options.items()}
    conf = dict(spark.sparkContext.getConf().getAll())
    conf.update(spark.conf.getAll)  # runtime settings of this session
    for key, value in conf.items():
        if key.startswith(CONF_PREFIX):
            merged[key[len(CONF_PREFIX):]] = value
    return merged


def _bool(key: str, raw: str) -> bool:
    low = raw.strip().lower()
    if low in ("true", "false"):
        return low == "true"
    raise AppendLogError(f"option {key} must be true or false, got {raw!r}")


def _int(key: str, raw: str, minimum: int) -> int:
    try:
        val = int(raw)
    except ValueError:
        raise AppendLogError(f"option {key} must be an integer, got {raw!r}") from None
    if val < minimum:
        raise AppendLogError(f"option {key} must be at least {minimum}, got {val}")
    return val


@dataclass(frozen=True)
class ReadConfig:
    spec: PathSpec
    starting_offsets: str
    max_bytes: int
    md5_check: bool
    md5_sample: int
    backup_provider: str
    backup_path: str
    split_bytes: int
    initial_offset_json: str
    stream_name: str
    batch_bytes: int | None = None
    catalog: str = "driver"
    catalog_path: str = ""
    target_path: str = ""
    prefix_block: int | None = None
    identity: bool = False

    @property
    def path(self) -> str:
        return self.spec.path

    @classmethod
    def from_options(cls, options) -> "ReadConfig":
        opts = {str(k): str(v) for k, v in dict(options).items()}
        unknown = sorted(set(opts) - KNOWN)
        if unknown:
            log.warning("appendlog: unknown options ignored: %s", ", ".join(unknown))
        get = lambda k: opts.get(k, DEFAULTS.get(k, EXTRA_DEFAULTS.get(k)))
        policy = get("starting.offsets").strip().lower()
        if policy not in POLICIES:
            raise AppendLogError(f"option starting.offsets must be earliest or latest, got {policy!r}")
        catalog = get("catalog").strip().lower()
        if catalog not in CATALOGS:
            raise AppendLogError(f"option catalog must be driver or manifest, got {catalog!r}")
        return cls(
            spec=parse_path(get("path")),
            starting_offsets=policy,
            max_bytes=_int("bytes.max", get("bytes.max"), 1),
            md5_check=_bool("md5.check.enabled", get("md5.check.enabled")),
            md5_sample=_int("md5.sample.length", get("md5.sample.length"), 1),
            backup_provider=get("offset.backup.provider"),
            backup_path=get("offset.backup.path"),
            split_bytes=_int("split.bytes", get("split.bytes"), 1),
            initial_offset_json=get("initial.offset.json"),
            stream_name=get("stream.name"),
            batch_bytes=_int("bytes.batch", get("bytes.batch"), 0) or None,
            catalog=catalog,
            catalog_path=get("catalog.path"),
            target_path=get("target.path"),
            identity=_bool("identity.check", get("identity.check")),
            prefix_block=_int("prefix.check.block", get("prefix.check.block"), 0) or None,
        )

    def as_rows(self) -> list[tuple[str, str]]:
        """Resolved key/value pairs, every key present (defaults filled)."""
        return [
            ("path", self.spec.path),
            ("starting.offsets", self.starting_offsets),
            ("bytes.max", str(self.max_bytes)),
            ("md5.check.enabled", str(self.md5_check).lower()),
            ("md5.sample.length", str(self.md5_sample)),
            ("offset.backup.provider", self.backup_provider),
        ]
