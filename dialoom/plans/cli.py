"""spark-submit entry: one layer, or all up to a given one.

    python -m dialoom.plans.cli all --input raw.jsonl --out work --dictionary dict.json [--bank bank.parquet] [--mode default] [--stop-after 3] [--repair]
    python -m dialoom.plans.cli retry --input work/out.jsonl --out work       the queue of an output once more
"""

from __future__ import annotations

import argparse
import sys
import time

from pyspark.sql import SparkSession

from dialoom.operators.dialogue import Mode
from dialoom.operators.rules import Limits
from dialoom.plans import pipeline
from dialoom.sources.dictionary import index, read_dictionary


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="dialoom")
    p.add_argument("stage", choices=["1", "2", "retry", "3", "4", "all"])
    p.add_argument("--input", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--dictionary")
    p.add_argument("--bank")
    p.add_argument("--mode", default="default")
    p.add_argument("--num-records", type=int)
    p.add_argument("--stop-after", type=int, default=4)
    p.add_argument("--overwrite", action="store_true")
    p.add_argument("--repair", action="store_true", help="mend rejected rows in the third layer; needs --dictionary")
    return p


def elapsed(seconds: float) -> str:
    return f"{int(seconds // 60)} min {seconds % 60:.1f} s" if seconds >= 60 else f"{seconds:.1f} s"


def main(argv: list[str] | None = None, spark: SparkSession | None = None, calls: pipeline.Models | None = None) -> int:
    a = parser().parse_args(argv)
    mode = Mode(a.mode)
    spark = spark or SparkSession.builder.appName("dialoom").config("spark.sql.mapKeyDedupPolicy", "LAST_WIN").getOrCreate()
    calls = calls or pipeline.Models()
    bank = spark.read.parquet(a.bank) if a.bank else None
    if a.stage == "retry":
        print(f"retry: {pipeline.run_retry(spark, a.input, calls, bank, mode)}", flush=True)
        return 0
    if a.repair and not a.dictionary:
        raise SystemExit("--repair needs --dictionary")
    wanted = range(1, a.stop_after + 1) if a.stage == "all" else [int(a.stage)]
    path = a.input
    for n in wanted:
        began = time.time()
        if n == 1:
            entries = index(read_dictionary(spark, a.dictionary)) if a.dictionary else None
            if entries is None:
                raise SystemExit("the first layer needs --dictionary")
            pipeline.run_first(spark, path, f"{a.out}/stage1", calls, entries, overwrite=a.overwrite)
            path, said = f"{a.out}/stage1", ""
        elif n == 2:
            path_out = f"{a.out}/{mode.output_file}"
            said = str(pipeline.run_second(spark, path, path_out, calls, bank, mode, a.num_records))
            path = path_out
        elif n == 3:
            tools = pipeline.repair_tools(calls, index(read_dictionary(spark, a.dictionary)), None, bank, mode) if a.repair else None
            said = str(pipeline.run_third(spark, path, f"{a.out}/stage3", calls, Limits(), tools))
            path = f"{a.out}/stage3/accepted"
        else:
            said = f"{pipeline.run_fourth(spark, path, f'{a.out}/reports')} rows"
        print(f"layer {n}: {elapsed(time.time() - began)} {said}", flush=True)
    return 0


if __name__ == "__main__":
    sys.exit(main())
