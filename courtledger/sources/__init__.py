from courtledger.sources.csv import read_optional, read_present, scan_csv, split_malformed
from courtledger.sources.landing import (
    compact,
    current_manifest,
    fingerprint,
    land,
    landed_counts,
    read_bronze,
)

__all__ = [
    "compact",
    "current_manifest",
    "fingerprint",
    "land",
    "landed_counts",
    "read_bronze",
    "read_optional",
    "read_present",
    "scan_csv",
    "split_malformed",
]
