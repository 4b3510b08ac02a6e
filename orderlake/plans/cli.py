"""Command-line entry points for spark-submit (via the root script ``run_job.py``).

    spark-submit --py-files orderlake.zip run_job.py ledger-to-bronze --blocks <dir> --bronze <dir>
    spark-submit --py-files orderlake.zip run_job.py bronze-to-silver --bronze <dir>
    spark-submit --py-files orderlake.zip run_job.py silver-to-gold --as-of 2024-01-01
    spark-submit --py-files orderlake.zip run_job.py clustering --csv <dir>
    spark-submit --py-files orderlake.zip run_job.py hdbscan --csv <dir>
    spark-submit --py-files orderlake.zip run_job.py compact --updates <dir> --state <dir>
    spark-submit --py-files orderlake.zip run_job.py ingest-stream --blocks ... --updates ... --checkpoint ...

The session comes from the cluster (``getOrCreate``); its configuration is
used as is. Printed output is the row counts the jobs observe while writing.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from orderlake.operators import ledger
from orderlake.plans import medallion
from orderlake.streaming import ingest


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="orderlake")
    sub = p.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("ledger-to-bronze")
    a.add_argument("--blocks", required=True)
    a.add_argument("--bronze", required=True)
    a.add_argument("--chaincode", default="mycc")
    a.add_argument("--json-lines", action="store_true", help="blocks are JSON lines, not one file per block")
    b = sub.add_parser("bronze-to-silver")
    b.add_argument("--bronze", required=True)
    b.add_argument("--namespace", default="silver")
    b.add_argument("--json-lines", action="store_true")
    g = sub.add_parser("silver-to-gold")
    g.add_argument("--silver", default="silver")
    g.add_argument("--gold", default="gold")
    g.add_argument("--as-of", default=None, help="recency reference date (default: today)")
    c = sub.add_parser("clustering")
    c.add_argument("--gold", default="gold")
    c.add_argument("--csv", default=None)
    c.add_argument("--eps", type=float, default=0.9)
    c.add_argument("--min-samples", type=int, default=10)
    h = sub.add_parser("hdbscan")
    h.add_argument("--gold", default="gold")
    h.add_argument("--csv", default=None)
    h.add_argument("--min-cluster-size", type=int, default=15)
    h.add_argument("--min-samples", type=int, default=8)
    k = sub.add_parser("compact")
    k.add_argument("--updates", required=True)
    k.add_argument("--state", required=True)
    k.add_argument("--buckets", type=int, default=64)
    s = sub.add_parser("ingest-stream")
    s.add_argument("--blocks", required=True)
    s.add_argument("--updates", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--continuous", action="store_true", help="keep running (default: process what is there)")
    args = p.parse_args(argv)

    spark = SparkSession.builder.appName(f"orderlake-{args.cmd}").getOrCreate()
    if args.cmd == "ledger-to-bronze":
        out = medallion.ledger_to_bronze(spark, args.blocks, args.bronze, args.chaincode, not args.json_lines)
    elif args.cmd == "bronze-to-silver":
        out = medallion.bronze_to_silver(spark, args.bronze, args.namespace, not args.json_lines)
    elif args.cmd == "silver-to-gold":
        out = medallion.silver_to_gold(spark, args.silver, args.gold, args.as_of)
    elif args.cmd == "clustering":
        out = medallion.clustering(spark, args.gold, args.csv, args.eps, args.min_samples)
    elif args.cmd == "hdbscan":
        out = medallion.hdbscan_clustering(spark, args.gold, args.csv, args.min_cluster_size, args.min_samples)
    elif args.cmd == "compact":
        out = {"folded_batch": ingest.compact(spark, args.updates, args.state, "orderId", ledger.ORDER_KEY_COLS, buckets=args.buckets)}
    else:
        q = ingest.run_ingest(spark, args.blocks, args.updates, args.checkpoint, available_now=not args.continuous)
        q.awaitTermination()
        out = {"batches": q.lastProgress["batchId"] + 1 if q.lastProgress else 0}
    print(json.dumps(out))


if __name__ == "__main__":
    main()
