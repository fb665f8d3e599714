"""Settings of the job. Secrets come from the caller, never from code."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class JdbcConfig:
    url: str
    table: str
    username: str
    password: str = field(repr=False)
    driver: str = "com.mysql.cj.jdbc.Driver"
    batch_size: int = 100
    staging_table: str | None = None
    connections: int = 8
    dialect: str = "mysql"

    def __post_init__(self):
        for name in ("url", "table", "username", "driver"):
            if not getattr(self, name):
                raise ValueError(f"JDBC setting {name!r} is required")
        if self.batch_size < 1 or self.connections < 1:
            raise ValueError("batch_size and connections must be positive")

    @property
    def staging(self) -> str:
        return self.staging_table or f"{self.table}_staging"


@dataclass(frozen=True)
class JobConfig:
    """How messages are read into lines. The defaults keep the established results.

    line_number        "quantity" stores the quantity as line number, "position" counts from 1
    escape_quotes      double single quotes in text, also in the keys looked up
    null_text          text stored for a JSON null and an unmatched marketplace; None stores NULL
    to_utc             shift dates to UTC instead of keeping their own wall clock
    case_insensitive   compare channel texts without regard to case
    on_error           "fail" stops at a malformed message, "quarantine" sets it aside
    refresh            "never" reads the channels once per run, "per_batch" for every micro-batch
    key_cols           the target's unique key
    broadcast_limit    bytes up to which a lookup table is broadcast; beyond, the join shuffles
    lookup_shares      where a lookup shuffles, the rows of a key with more than one part in so many of all rows are
                       dealt out evenly
    """

    line_number: str = "quantity"
    escape_quotes: bool = True
    null_text: str | None = "null"
    to_utc: bool = False
    case_insensitive: bool = False
    on_error: str = "fail"
    refresh: str = "never"
    key_cols: tuple[str, ...] = ("id", "remote_order_item_id")
    broadcast_limit: int = 64 * 1024 * 1024
    lookup_shares: int = 1024

    def __post_init__(self):
        allowed = {
            "line_number": ("quantity", "position"),
            "on_error": ("fail", "quarantine"),
            "refresh": ("never", "per_batch"),
        }
        for name, values in allowed.items():
            if getattr(self, name) not in values:
                raise ValueError(f"{name} must be one of {values}")
        if not self.key_cols:
            raise ValueError("key_cols must not be empty")
        if self.lookup_shares < 1:
            raise ValueError("lookup_shares must be positive")
