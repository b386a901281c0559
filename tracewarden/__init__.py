"""Log integrity analytics on Spark: time gaps, error bursts, hash chains, risk."""

from tracewarden.config import ScanConfig
from tracewarden.plans.scan import ScanResult, scan_files, scan_lines, scan_parsed

__all__ = ["ScanConfig", "ScanResult", "scan_files", "scan_lines", "scan_parsed"]
