"""The recorder's position: forward only, moved only with proof that the feed was stored."""

from __future__ import annotations

import dataclasses
import datetime as dt
import json
from dataclasses import dataclass

from registry_lens.config import CONFIG, Config

_MINT = object()


class FeedReceipt:
    """Proof that a stretch of the feed is durable; only ``store_feed`` can make one."""

    def __init__(self, token: object, key: str, last_seq: int, size: int):
        if token is not _MINT:
            raise TypeError("a receipt comes from storing a feed blob")
        self.key, self.last_seq, self.size = key, last_seq, size


def store_feed(write, key: str, last_seq: int) -> FeedReceipt:
    """Call ``write()``, which returns the bytes stored; its success is what the receipt proves."""
    return FeedReceipt(_MINT, key, last_seq, int(write()))


@dataclass(frozen=True)
class Cursor:
    """One row of state; unknown fields of a stored one are dropped, missing ones take their default."""

    last_seq: int
    pending_key: str | None = None
    prev_sha256: str | None = None
    prev_run_id: str | None = None
    osv_watermark: str | None = None
    month: str | None = None
    month_bytes: int = 0
    anchor_at: str | None = None
    bytes_since_anchor: int = 0
    runs: int = 0

    @classmethod
    def read(cls, text: str) -> Cursor:
        data = json.loads(text)
        if isinstance(data.get("last_seq"), bool) or not isinstance(data.get("last_seq"), int):
            raise ValueError("the cursor has no usable position")
        known = {f.name for f in dataclasses.fields(cls)}
        return cls(**{k: v for k, v in data.items() if k in known and v is not None})

    def text(self) -> str:
        return json.dumps(dataclasses.asdict(self), indent=2) + "\n"

    @classmethod
    def bootstrap(cls, head: int, hours: float, existing: Cursor | None = None, force: bool = False, config: Config = CONFIG) -> Cursor:
        """Start some hours before the head; refused when there is a position already."""
        if existing is not None and not force:
            raise ValueError("there is a cursor already")
        return cls(max(0, head - int(hours * config.seq_per_hour)))

    @classmethod
    def recover(cls, max_seq: int, existing: Cursor | None, force: bool = False) -> Cursor:
        """Position from the names of stored feed blobs; a move forward would skip rows and is refused."""
        if existing is not None and max_seq > existing.last_seq and not force:
            raise ValueError("recovering would skip rows")
        return cls(max_seq)

    def check_head(self, head: int) -> None:
        if self.last_seq > head:
            raise ValueError(f"the cursor {self.last_seq} is past the feed's head {head}")

    def advance(self, receipt: FeedReceipt, now: dt.datetime) -> Cursor:
        """Position after a stored blob; the monthly byte counter starts anew with each month."""
        if not isinstance(receipt, FeedReceipt):
            raise TypeError("advancing takes a receipt")
        if receipt.last_seq < self.last_seq:
            raise ValueError("a cursor never goes back")
        month = now.strftime("%Y-%m")
        carried = self.month_bytes if month == self.month else 0
        return dataclasses.replace(self, last_seq=receipt.last_seq, pending_key=receipt.key, month=month, month_bytes=carried + receipt.size, bytes_since_anchor=self.bytes_since_anchor + receipt.size)

    def complete(self, run_id: str, manifest_sha256: str) -> Cursor:
        return dataclasses.replace(self, pending_key=None, prev_sha256=manifest_sha256, prev_run_id=run_id, runs=self.runs + 1)

    def with_watermark(self, modified: str) -> Cursor:
        """A newer advisory watermark; an older one changes nothing."""
        return dataclasses.replace(self, osv_watermark=max(self.osv_watermark or "", modified))

    def with_anchor(self, at: str) -> Cursor:
        """A newer usage measurement starts the drift anew."""
        if self.anchor_at is not None and at <= self.anchor_at:
            return self
        return dataclasses.replace(self, anchor_at=at, bytes_since_anchor=0)
