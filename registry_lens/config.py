"""Tunables, passed to operators; every window and cap is a field."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Config:
    """Fixed values of the domain, as defaults: windows in seconds, sizes in bytes, limits in rows, and what a security holder looks like."""

    feed_page_limit: int = 10_000
    feed_seq_per_row_min: float = 1.5
    feed_seq_per_row_max: float = 12.0
    backlog_threshold: int = 3_000
    triage_threshold: int = 50_000
    recent_lookback_s: int = 30 * 86_400
    times_window_s: int = 7 * 86_400
    times_cap: int = 100
    missing_cap: int = 100
    recent_cap: int = 20
    new_package_window_s: int = 48 * 3_600
    clock_skew_s: int = 3_600
    max_document_bytes: int = 32 * 1024 * 1024
    max_retained_bytes: int = 512 * 1024
    fetch_cut_s: int = 38 * 60
    fetch_wave: int = 50_000
    shard_max_rows: int = 2_000
    shard_max_bytes: int = 16 * 1024 * 1024
    retain_flags: tuple[str, ...] = ("new_package", "package_unpublished", "install_scripts")
    retain_flags_soft: tuple[str, ...] = ("package_unpublished",)
    storage_free_bytes: int = 10_000_000_000
    soft_fraction: float = 0.75
    hard_fraction: float = 0.92
    usage_stale_s: int = 7 * 86_400
    mirror_prefixes: tuple[str, ...] = ("raw/feed/", "raw/runs/", "raw/obs/", "raw/osv/", "private/")
    probe_key: str = "mirror/probe.json"
    state_key: str = "mirror/state.json"
    holder_repo: str = "git+https://github.com/npm/security-holder.git"
    holder_login: str = "npm"
    holder_email: str = "npm@npmjs.com"
    seq_per_hour: int = 5_000
    max_pages: int = 64
    max_advisories: int = 2_000


CONFIG = Config()
