"""The report set of a line of business: its summary, open batches and open folders.

What its reports have in common is built once, in the shared folder: the line's batches, folders and
upload records, from which the open batches and all sheets come.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from scanyard import fixed
from scanyard.plans.config import Line
from scanyard.plans.extracts import (Tables, box_batches, folder_names, folder_records,
                                     line_folders)
from scanyard.plans.outstanding import (open_batches, r02_outstanding_batches,
                                        r03_outstanding_folders, r06_open_batches,
                                        r07_open_folders)
from scanyard.plans.summary import r01_box_summary, r04_vault_summary, r05_box_summary
from scanyard.session import shared_dir
from scanyard.sources.roles import Roles


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _with(tables: Tables, name: str, df: DataFrame) -> Tables:
    return Roles({role: (lambda role=role: tables[role]) for role in tables} | {name: lambda: df})


def with_folder_names(tables: Tables) -> Tables:
    """The tables, and the folders of batches built once for the report sets of several lines."""
    folders = folder_names(tables)
    path = f"{shared_dir(folders.sparkSession)}/folder_names"
    return _with(tables, "folder_names", _stored(folders, path))


def with_line(tables: Tables, line: Line) -> Tables:
    """The tables, and what the reports of this one line read several times, built once.

    Those are its batches, the folders that may be of them, and its upload records by folder.
    """
    base = shared_dir(tables["check_in"].sparkSession)
    tables = _with(tables, "line_batches", _stored(box_batches(tables, line), f"{base}/batches"))
    folders = line_folders(tables, line).distinct()
    records = _stored(folder_records(tables, line), f"{base}/records")
    return _with(_with(tables, "line_folders", _stored(folders, f"{base}/folders")),
                 "line_records", records)


def report_set(tables: Tables, line: Line, as_of: datetime) -> dict[str, DataFrame]:
    """Sheet name to report. What they share is built once, in the shared folder.

    Lines of one claim type report without ages; a line of one kind of box reports only its
    unfinished boxes.
    """
    tables = with_line(tables, line)
    built = open_batches(tables, line)
    batches = _stored(built, f"{shared_dir(built.sparkSession)}/open_batches")
    if line.claim:
        summary = r05_box_summary(tables, line, as_of)
        reports = r06_open_batches, r07_open_folders
    else:
        summary = (r04_vault_summary if line.box_prefix else r01_box_summary)(tables, line, as_of)
        reports = r02_outstanding_batches, r03_outstanding_folders
    sheets = {f"{line.name} Summary": summary}
    for name, report in zip(fixed.OUTSTANDING_SHEETS, reports):
        sheets[name] = report(tables, line, as_of, batches=batches)
    return sheets
