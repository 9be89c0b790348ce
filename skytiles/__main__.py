"""Command line for the catalogue jobs: ``python -m skytiles JOB ...``
(on a cluster, ship the package with ``--py-files`` and call
``skytiles.__main__.main(argv)`` from the submitted script).

    bounds    INPUT [--recentre]              J6: print the bounding box
    counts    INPUT [OUTPUT]                  J5: detections per object
    summary   INPUT OUTPUT [--numeric-last]   J4: per-object summary lines
    grid      CELLS INPUT OUTPUT              J1: one cell per star
    strips    INPUT OUTPUT [--strips 40]      J2: RA strips
    partition CELLS INPUT OUTPUT [--cap]      J3: padded cells with a cap

INPUT is a Source catalogue (header-less CSV by default, ``--format
parquet`` for Parquet). CELLS is the least number of cells, or ``auto``:
the input's size divided by ``--target-bytes``. With ``--measure`` the rows
are weighed as they are encoded: outputs are of about ``--target-bytes``, and
``auto`` goes by that weight. Outputs are written under
OUTPUT, which must not exist unless ``--overwrite`` is given; the cell jobs
print their histogram as ``cell-->bar`` lines. The session comes from
``SparkSession.builder.getOrCreate()``, so cluster settings (and
``spark.checkpoint.dir``) apply.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .operators import bounds, cells_for_size, histogram_lines, object_counts
from .operators.capacity import MAX_PER_CELL, ROWS_PER_TASK
from .operators.grid import DECL_PADDING, RA_PADDING, TARGET_FILE_BYTES
from .operators.strips import N_STRIPS, STRIP_MARGIN
from .plans import (run_grid_job, run_object_count_job, run_object_summary_job,
                    run_partition_job, run_strip_job)
from .session import input_bytes
from .sources import read_source, source_points


def _cells(text: str) -> int | None:
    return None if text == "auto" else int(text)


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="skytiles", description=__doc__.split("\n\n")[0])
    src = argparse.ArgumentParser(add_help=False)
    src.add_argument("--format", default="csv", choices=["csv", "parquet"],
                     help="input format of the Source catalogue")
    over = argparse.ArgumentParser(add_help=False)
    over.add_argument("--overwrite", action="store_true",
                      help="replace an output folder that exists")
    sized = argparse.ArgumentParser(add_help=False)
    sized.add_argument("--target-bytes", type=int, default=TARGET_FILE_BYTES,
                       help="size of an output that CELLS 'auto' and --measure aim at")
    sized.add_argument("--measure", action="store_true",
                       help="outputs of about --target-bytes, by the size of encoded rows")
    out = argparse.ArgumentParser(add_help=False)
    out.add_argument("--out-format", default="parquet", choices=["csv", "parquet"],
                     help="format of the per-cell outputs")
    out.add_argument("--columns", default=None,
                     help="comma list of columns to write per cell (default: all "
                          "point columns; 'ra,decl' gives the original line format)")
    sub = p.add_subparsers(dest="job", required=True)
    b = sub.add_parser("bounds", parents=[src])
    b.add_argument("input")
    b.add_argument("--recentre", action="store_true")
    c = sub.add_parser("counts", parents=[src, over])
    c.add_argument("input")
    c.add_argument("output", nargs="?")
    s = sub.add_parser("summary", parents=[src, over])
    s.add_argument("input")
    s.add_argument("output")
    s.add_argument("--numeric-last", action="store_true")
    g = sub.add_parser("grid", parents=[src, out, over, sized])
    g.add_argument("min_cells", type=_cells, metavar="CELLS")
    g.add_argument("input")
    g.add_argument("output")
    t = sub.add_parser("strips", parents=[src, out, over, sized])
    t.add_argument("input")
    t.add_argument("output")
    t.add_argument("--strips", type=int, default=N_STRIPS)
    t.add_argument("--margin", type=float, default=STRIP_MARGIN)
    j = sub.add_parser("partition", parents=[src, out, over, sized])
    j.add_argument("min_cells", type=_cells, metavar="CELLS")
    j.add_argument("input")
    j.add_argument("output")
    j.add_argument("--cap", type=int, default=MAX_PER_CELL)
    j.add_argument("--ra-pad", type=float, default=RA_PADDING)
    j.add_argument("--decl-pad", type=float, default=DECL_PADDING)
    j.add_argument("--decl-band", default="j", choices=["i", "j"])
    j.add_argument("--sphere", action="store_true",
                   help="padding measured on the sky: RA a circle, wider towards the poles")
    j.add_argument("--rows-per-task", type=int, default=ROWS_PER_TASK,
                   help="largest cell ranked in one task before splitting")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"skytiles-{args.job}").getOrCreate()
    points = source_points(read_source(spark, args.input, fmt=args.format))
    columns = args.columns.split(",") if getattr(args, "columns", None) else None
    mode = "overwrite" if getattr(args, "overwrite", False) else "errorifexists"
    measure = getattr(args, "measure", False)
    if getattr(args, "min_cells", 0) is None and not measure:
        args.min_cells = cells_for_size(input_bytes(spark, args.input), args.target_bytes)
    if args.job == "bounds":
        print(bounds(points, recentre=args.recentre).first().asDict())
        return 0
    if args.job == "counts":
        if args.output:
            run_object_count_job(points, args.output, mode)
        else:
            for row in object_counts(points).toLocalIterator():
                print(f"{row.object_id},{row.n_sources}")
        return 0
    if args.job == "summary":
        run_object_summary_job(points, args.output, mode, numeric_last=args.numeric_last)
        return 0
    # CSV is parsed once; Parquet passes read the columns they need.
    common = {"columns": columns, "fmt": args.out_format, "mode": mode,
              "store_points": args.format == "csv",
              "target_bytes": args.target_bytes if measure else None}
    if args.job == "grid":
        hist = run_grid_job(points, args.output, args.min_cells, **common)
    elif args.job == "strips":
        hist = run_strip_job(points, args.output, args.strips, args.margin, **common)
    else:
        hist = run_partition_job(points, args.output, min_cells=args.min_cells,
                                 ra_pad=args.ra_pad, decl_pad=args.decl_pad,
                                 cap=args.cap, decl_band=args.decl_band, sphere=args.sphere,
                                 rows_per_task=args.rows_per_task, **common)
    for row in histogram_lines(hist).toLocalIterator():
        print(row.value)
    return 0


if __name__ == "__main__":
    sys.exit(main())
