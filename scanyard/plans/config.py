"""One settings object per line of business; the pipelines are shared."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import datetime

from scanyard import fixed


@dataclass(frozen=True)
class Line:
    """Which boxes, batches and uploads belong to a line of business."""

    name: str
    # boxes
    claim: str | None = None
    not_claim: str | None = None
    box_origin: str | None = None
    box_source: str | None = None
    box_prefix: str | None = None
    inserted_since: datetime | None = None
    # batches
    batch_prefix: str | None = None
    received_since: datetime | None = None
    skip_test_batches: bool = False
    # uploads
    imaged_since: datetime | None = None
    imaged_since_inclusive: bool = True
    upload_prefix: str | None = None
    uploads_need_box: bool = True
    image_grain: bool = False
    # workflow
    latest_receipt_only: bool = False
    # lookups and labels
    scanned_role: str = "scanner_stats"
    not_scanned: str = fixed.PENDING_SCANNER
    # open batches and folders: the second OCR job, the receipt day, whose folder number
    second_job: bool = True
    show_day: bool = True
    recorded_folder: bool = True

    def starting(self, start: datetime) -> Line:
        """The same line with every start date that is set moved to ``start``."""
        dates = ("inserted_since", "received_since", "imaged_since")
        return replace(self, **{d: start for d in dates if getattr(self, d) is not None})


FCS = Line(
    name="FCS", not_claim="OMPF", box_origin="fcs", box_source="ro",
    batch_prefix="02", received_since=datetime(2020, 6, 1),
    imaged_since=datetime(2020, 6, 1), imaged_since_inclusive=False, upload_prefix="02",
)
VAULT = Line(
    name="Vault", box_prefix="101",
    batch_prefix="01", received_since=datetime(2021, 4, 1),
    imaged_since=datetime(2021, 4, 1), imaged_since_inclusive=False, upload_prefix="01",
    uploads_need_box=False,
)
OMPF_FIRST = Line(
    name="OMPF, first generation", claim="OMPF",
    received_since=datetime(2020, 6, 1),
    imaged_since=datetime(2020, 6, 1), imaged_since_inclusive=False, image_grain=True,
    second_job=False, show_day=False, recorded_folder=False,
)
OMPF = Line(
    name="OMPF", claim="OMPF", inserted_since=datetime(2021, 6, 10),
    received_since=datetime(2021, 6, 10), skip_test_batches=True,
    imaged_since=datetime(2021, 6, 10), image_grain=True, latest_receipt_only=True,
    scanned_role="audit", not_scanned=fixed.PENDING_SCAN,
)
# Straight from the source tables, without staging.
OMPF_DIRECT = Line(
    name="OMPF, direct", claim="OMPF", batch_prefix="02", received_since=datetime(2020, 6, 1),
)
IMAGE_INVENTORY = Line(
    name="image inventory", claim="OMPF", batch_prefix="02",
    received_since=datetime(2021, 6, 10), skip_test_batches=True,
)
BOX_INVENTORY = Line(
    name="box inventory", claim="OMPF", inserted_since=datetime(2021, 6, 10),
    batch_prefix="02", received_since=datetime(2021, 6, 10),
)
# Workflow job the image inventory looks at.
INVENTORY_JOB = 8


@dataclass(frozen=True)
class Feed:
    """Time bounds of the completed-work feed."""

    uploaded_since: datetime = datetime(2021, 1, 1)
    received_since: datetime = datetime(2018, 8, 27)
    # Uploads strictly inside this span are left out when their folder is excluded; an open
    # end leaves out everything after the start, and no span at all leaves out nothing.
    excluded_after: datetime | None = datetime(2021, 5, 1)
    excluded_before: datetime | None = datetime(2021, 6, 1)
