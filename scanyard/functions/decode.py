"""Codes to words."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from scanyard import fixed
from scanyard.functions.text import concat_text


def _cases(pairs) -> Column:
    """First condition that holds decides; none gives NULL."""
    (condition, value), *rest = pairs
    out = F.when(condition, value)
    for condition, value in rest:
        out = out.when(condition, value)
    return out


def _by_code(code: Column, names: Mapping[int, str]):
    return [(code == k, F.lit(v)) for k, v in names.items()]


def stage_name(step: Column, location: Column) -> Column:
    """Workflow stage; verification and export also look at the location."""
    at_verification = (step == fixed.VERIFICATION_STEP) & (location == fixed.VERIFICATION_LOCATION)
    at_export = (step == fixed.EXPORT_STEP) & (location != fixed.CLEAN_LOCATION)
    return _cases(_by_code(step, fixed.STAGE_NAMES) + [
        (at_verification, F.lit(fixed.VERIFICATION_NAME)),
        (at_export, F.lit(fixed.EXPORT_NAME)),
    ])


def batch_status(exported: Column, code: Column, batch: Column) -> Column:
    """Exported wins, then the code; a batch unknown to the workflow is not imported."""
    return _cases(
        [(exported.isNotNull(), F.lit(fixed.EXPORTED))]
        + _by_code(code, fixed.BATCH_STATUS)
        + [(batch.isNull(), F.lit(fixed.NOT_IMPORTED))]
    )


def outstanding_status(status: Column, scanned: Column, not_scanned: str,
                       second_ocr: Column | None = None) -> Column:
    """Status of a batch still open, refined by the scanner and the second OCR job.

    ``scanned`` and ``second_ocr`` are true where the batch is known there.
    """
    cases = [] if second_ocr is None else [(second_ocr, F.lit(fixed.SECOND_OCR))]
    cases += [
        (status == fixed.EXPORTED, F.lit(fixed.PENDING_UPLOAD)),
        ((status == fixed.NOT_IMPORTED) & ~scanned, F.lit(not_scanned)),
    ]
    return _cases(cases).otherwise(status)


def either(matched: Column, value: Column, other: Column) -> Column:
    """The matched side's value, even when NULL; else the other."""
    return F.when(matched, value).otherwise(other)


def or_dash(c: Column) -> Column:
    return F.coalesce(c, F.lit("-"))


def or_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def media_flag(batch_class: Column) -> Column:
    """Special media or paper; unknown counts as paper."""
    return F.when(batch_class == "SM", "SM").otherwise("P")


def media_counts(batch_class: Column, folders: Column) -> tuple[Column, Column]:
    """Folder count as (paper, special media); an unknown class gives 0 in both."""
    paper = F.when(batch_class != "SM", folders).otherwise(F.lit(0))
    special = F.when(batch_class == "SM", folders).otherwise(F.lit(0))
    return paper, special


def module_name(step: Column, location: Column) -> Column:
    """Module at a step and location, or a text naming the odd combination."""
    cases = [((step == s) & (location == at), F.lit(name))
             for (s, at), name in fixed.MODULE_NAMES.items()]
    odd = concat_text(F.lit("WFStep"), step, F.lit(" BchLoc "), location,
                      F.lit(" - LocationError"))
    return _cases(cases).otherwise(odd)


def module_status(code: Column) -> Column:
    return _cases(_by_code(code, fixed.MODULE_STATUS))


def job_name(batch: Column, box: Column, claim: Column) -> Column:
    """Billing job from batch prefix, box prefix and claim type."""
    vault = box.startswith("101")
    in_01, in_02 = batch.startswith("01"), batch.startswith("02")
    return _cases([
        (in_01 & vault, F.lit("VAULT")),
        (in_01 & ~vault, F.lit("RMC")),
        (in_02 & (claim != "OMPF"), F.lit("FCS")),
        (in_02 & (claim == "OMPF"), F.lit("OMPF")),
        (batch.startswith("07"), F.lit("BWN")),
        (batch.startswith("08"), F.lit("REA")),
    ])


def completion(total: Column, uploaded: Column) -> Column:
    return F.when(total == uploaded, fixed.COMPLETED).otherwise(fixed.PARTIAL)


def pending_text(total: Column, uploaded: Column) -> Column:
    """How many documents of an exported batch still wait."""
    return concat_text(F.lit(fixed.EXPORTED + " ["), total - uploaded, F.lit(" of "), total,
                       F.lit(" doc(s) pending upload]"))


def inventory_stage(step: Column, location: Column) -> Column:
    """Inventory column a batch is counted in, NULL for none."""
    return _cases([
        (step == s if at is None else (step == s) & (location == at), F.lit(name))
        for name, s, at in fixed.INVENTORY_STAGES
    ])
