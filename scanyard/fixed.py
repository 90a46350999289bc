"""Codes, names and labels the reports must show exactly as agreed."""

# Placeholder shipment number that never counts as a shipment.
DUMMY_TRACKING = "1234DUMMY1234"

# Batch names holding one of these words are not production work.
TEST_WORDS = ("test", "train")

# Workflow step -> stage name. Steps 12 and 13 also depend on the location.
STAGE_NAMES = {
    1: "Capture",
    2: "Enhance1",
    3: "FOCR",
    4: "Enhance2",
    5: "Separation",
    6: "ImageQC",
    7: "AutoIndex",
    8: "DocID",
    9: "DocIDQC",
    10: "Manual Index",
    11: "Manual IndexQC",
}
VERIFICATION_STEP, VERIFICATION_LOCATION, VERIFICATION_NAME = 12, 64, "Verification"
EXPORT_STEP, EXPORT_LOCATION, EXPORT_NAME = 13, 256, "Export"
CLEAN_LOCATION = 0

# (step, location) -> module name, used by the verification queue.
MODULE_NAMES = {
    (1, 1): "Scan/Capture",
    (2, 2): "Enhance1",
    (3, 16): "FOCR1",
    (4, 2): "Enhance2",
    (5, 4): "Separation",
    (6, 128): "QA1",
    (7, 8): "AutoIndex",
    (8, 128): "QA2",
    (9, 128): "QA3",
    (10, 32): "ManualIndex",
    (11, 32): "ManualIndex2",
    (12, 64): "Verification/BVTI",
    (13, 256): "Export",
    (13, 0): "Clean",
}

# Batch status codes.
BATCH_STATUS = {1: "Ready", 2: "In Process", 4: "Suspended", 8: "Auto-Fail"}
MODULE_STATUS = {0: "Error", 1: "Ready", 2: "In Process", 4: "Suspended", 8: "Auto-Fail"}

# Status words that do not come from a code.
EXPORTED = "Exported"
NOT_IMPORTED = "Pending OpenBox Import"
PENDING_UPLOAD = "Pending Upload"
PENDING_SCAN = "Pending Scan"
PENDING_SCANNER = "Pending IBML Scan"
SECOND_OCR = "WIP 2nd Job OCR"
COMPLETED, PARTIAL = "Completed", "Partial"

# Inventory columns: (name, step, location or None for any location).
INVENTORY_STAGES = (
    ("Capture", 1, None),
    ("Enhance1", 2, None),
    ("FullPageOCR", 3, None),
    ("Enhance2", 4, None),
    ("Separation", 5, None),
    ("ImageQC", 6, None),
    ("AutoIndex", 7, None),
    ("DocID", 8, None),
    ("DocIDQC", 9, None),
    ("ManualIndex", 10, None),
    ("Verification", 12, 64),
    ("Export", 13, 256),
    ("Clean", 13, 0),
)

# Billing attributes of the completed-work feed.
FEED_ATTRIBUTES = {
    "CustomerName": "VA",
    "ProcessType": "OpenBox",
    "Status": "COMPLETED",
    "SiteName": "MTV",
    "Vertical": "Public Sector",
    "Region": "NA",
    "Country": "US",
    "BillType": "NA",
    "Sub-Process": "Upload",
    "Characters": 0,
}
FEED_PREFIXES = ("01", "02", "07", "08")

# Labels of the daily completed counts.
BOXES_DONE = "RMNs Uploaded by GDIT"
FOLDERS_DONE = "DCSIDs Uploaded by GDIT"

# Report headers, in print order.
# Sheet names of a line's report set; the first is its name and "Summary".
OUTSTANDING_SHEETS = ("Outstanding Batches", "Outstanding DCSIDs")
BOX_SUMMARY_HEADER = (
    "RMN", "TrackingNo", "TotalBatches", "TotalDCSIDs", "InProgress(Batches)",
    "Exported(Batches)", "Uploaded(Batches)", "Uploaded(DCSIDs)",
)
AGED_BATCH_HEADER = (
    "RMN", "TrackingNo", "BatchName", "InvTime", "TAT(Days)", "OpenBoxBatchLocation",
    "BatchStatus", "TotalImages(OpenBox)", "SpecialMedia/Paper", "Paper(DCSID Count)",
    "SpecialMedia(DCSID Count)",
)
AGED_FOLDER_HEADER = (
    "RMN", "TrackingNo", "BatchName", "InvTime", "TAT(Days)", "DCSID",
    "OpenBoxBatchLocation", "BatchStatus", "TotalImages(OpenBox)", "SpecialMedia/Paper",
)
OPEN_BATCH_HEADER = (
    "RMN", "TrackingNo", "BatchName", "InvDate", "OpenBoxBatchLocation", "BatchStatus",
    "TotalImages(OpenBox)", "SpecialMedia/Paper", "Paper(DCSID Count)",
    "SpecialMedia(DCSID Count)",
)
OPEN_FOLDER_HEADER = (
    "RMN", "TrackingNo", "BatchName", "InvDate", "DCSID", "OpenBoxBatchLocation",
    "BatchStatus", "TotalImages(OpenBox)", "SpecialMedia/Paper",
)
FEED_HEADER = (
    "Received", "CustomerName", "JobName", "ProcessType", "BatchName", "Status",
    "ImageCount", "DocCount", "SiteName", "CompleteDate", "Vertical", "Region", "Country",
    "BillType", "Sub-Process", "Boxes", "Characters",
)
