"""Engine settings: one frozen object, whose patterns become literals in the plan."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields

# The phrases that gazettes use.
ANCHORS = (r"Section\s+39A", r"39A/Notification", r"change of zone", r"No Development Zone")
SPAN_ENDS = (r"And whereas, in terms of sub-rule \(1\) of rule 4", r"Department of Town & Country Planning")
RUNNING_TEXT = (
    r"^OFFICIAL\s+GAZETTE\s*[-—–]?\s*GOVT",
    r"^SERIES\s+[IVX]+\s+No\.?\s*\d+",
    r"^\d{1,2}\s*(ST|ND|RD|TH)\s+[A-Z]+,?\s+\d{4}$",
    r"^\d{1,5}$",
)


@dataclass(frozen=True)
class EngineConfig:
    """Paths, patterns and limits.  ``from_env`` reads fields from upper-case variables."""

    data_dir: str = "data"
    inbox_dir: str = "data/inbox"
    processed_dir: str = "data/processed"
    failed_dir: str = "data/failed"
    gazettes_dir: str = "data/gazettes"
    out_dir: str = "data/out"
    ledger_dir: str = "data/ledger"
    poll_interval_seconds: float = 5.0
    ocr_engine: str = "rapidocr"
    rapidocr_backend: str = "torch"
    ocr_scale: float = 4.0
    preprocess_scans: bool = False
    profile_timings: bool = False
    anchor_patterns: tuple[str, ...] = ANCHORS
    span_end_patterns: tuple[str, ...] = SPAN_ENDS
    running_text_patterns: tuple[str, ...] = RUNNING_TEXT
    mapper: str = "heuristic"  # or ollama, openai_compat
    mapper_url: str = "http://localhost:11434"
    mapper_model: str = ""
    mapper_key: str = ""
    sheet_id: str | None = None
    sheet_credentials: str | None = None
    tab_rows: str = "Rows"
    tab_plots: str = "Plots"
    tab_review: str = "Review"
    timezone: str = "Asia/Kolkata"
    scanned_below_chars: int = 50
    running_text_max: int = 80
    header_ratio: float = 0.8

    @classmethod
    def from_env(cls, env: dict[str, str] | None = None) -> EngineConfig:
        env = dict(os.environ if env is None else env)
        found = {}
        for f in fields(cls):
            raw = env.get(f.name.upper())
            if raw is None:
                continue
            default = f.default
            if isinstance(default, bool):
                found[f.name] = raw.strip().lower() in ("1", "true", "yes", "on")
            elif isinstance(default, tuple):
                found[f.name] = tuple(x for x in raw.split("\n") if x)
            elif isinstance(default, int | float):
                found[f.name] = type(default)(raw)
            else:
                found[f.name] = raw
        return cls(**found)

    def ocr_options(self) -> dict:
        """Options of the OCR engine, for a parser plug-in."""
        if self.ocr_engine == "rapidocr":
            return {"engine": "rapidocr", "backend": self.rapidocr_backend, "use_cls": False}
        if self.ocr_engine == "ocrmac":
            return {"engine": "ocrmac"}
        raise ValueError(f"unknown OCR engine: {self.ocr_engine}")

    def sheets_enabled(self) -> bool:
        return bool(self.sheet_id and self.sheet_credentials)

    def make_dirs(self) -> None:
        for f in fields(self):
            if f.name.endswith("_dir"):
                os.makedirs(getattr(self, f.name), exist_ok=True)
