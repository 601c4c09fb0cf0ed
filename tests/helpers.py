"""Literal records in the shape of the source files."""

from __future__ import annotations

import datetime
import gzip
import json
from pathlib import Path

UTC = datetime.timezone.utc


def at(text: str) -> datetime.datetime:
    return datetime.datetime.fromisoformat(text)


def booking(**changes) -> dict:
    base = {
        "booking_id": "B1", "customer_id": "C1", "provider_id": "P1", "service_id": "S1", "booking_city": "Pune",
        "booking_created_at": "2026-01-05T10:00:00Z", "scheduled_at": "2026-01-06T10:00:00Z",
        "service_started_at": None, "service_completed_at": None, "booking_status": "BOOKED",
        "gross_amount": 100.0, "discount_amount": 0.0, "tax_amount": 18.0, "final_amount": 118.0,
        "payment_method": "UPI", "rating": None, "review_text": None, "record_updated_at": "2026-01-05T11:00:00Z",
    }
    return {**base, **changes}


def provider(**changes) -> dict:
    base = {
        "provider_id": "P1", "provider_name": "Partner 1", "primary_city": "Pune", "operating_zone": "North",
        "provider_tier": "STANDARD", "experience_level": "EXPERT", "active_status": "ACTIVE",
        "primary_service_category": "Plumbing", "effective_at": "2026-01-01T00:00:00Z",
        "record_updated_at": "2026-01-01T00:00:00Z",
    }
    return {**base, **changes}


def customer(**changes) -> dict:
    return {"customer_id": "C1", "customer_name": "Customer 1", "customer_segment": "NEW", "home_city": "pune",
            "signup_date": "2024-05-01", "is_active": True, **changes}


def service(**changes) -> dict:
    return {"service_id": "S1", "service_name": "Pipe Repair", "service_category": "Plumbing", "standard_price": 399,
            "expected_duration_minutes": 45, "skill_level_required": "basic", "is_active": True, **changes}


def raw(spark, records: list, ingested: list[str] | None = None, filename: str = "f.json.gz"):
    """Raw envelope rows; a record may be a dict or a line as it stands."""
    rows = [(r if isinstance(r, str) else json.dumps(r), filename, i + 1,
             at((ingested or ["2026-02-01T00:00:00"] * len(records))[i])) for i, r in enumerate(records)]
    return spark.createDataFrame(
        rows, "payload string, source_filename string, source_row_number bigint, ingested_at timestamp")


def write_lines(path: Path, records: list) -> str:
    path.parent.mkdir(parents=True, exist_ok=True)
    with gzip.open(path, "wt", encoding="utf-8") as f:
        for r in records:
            f.write((r if isinstance(r, str) else json.dumps(r)) + "\n")
    return str(path)
