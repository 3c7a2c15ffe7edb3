"""JDBC options. Credentials are arguments; nothing is stored here."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Connection:
    url: str
    user: str
    password: str
    driver: str | None = None
    fetch_size: int = 10_000
    batch_size: int = 10_000

    def __repr__(self) -> str:
        return f"Connection(url={self.url!r}, user={self.user!r})"

    def options(self) -> dict[str, str]:
        found = {
            "url": self.url,
            "user": self.user,
            "password": self.password,
            "fetchsize": str(self.fetch_size),
            "batchsize": str(self.batch_size),
        }
        return found if self.driver is None else found | {"driver": self.driver}


@dataclass(frozen=True)
class ReadSlices:
    """Ranges of a numeric, date or timestamp column; the end ranges are open, so no row is missed."""

    column: str
    lower: int | str
    upper: int | str
    count: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.count),
        }
