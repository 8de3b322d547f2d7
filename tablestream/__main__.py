"""Command line: load a folder of JSON-line message files into a table store.

    spark-submit --py-files tablestream.zip -m tablestream \\
        --config config.json --input s3://logs/ --base s3://warehouse/ [--watch]

``--config`` takes the reference-style option names (see ``tablestream.config``).
Without ``--watch`` the input is drained once (``availableNow``) and the job ends.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from .config import loader_from_config
from .session import checkpoint_dir, configure


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="tablestream")
    p.add_argument("--config", help="JSON config file (reference option names)")
    p.add_argument("--input", required=True, help="folder (or glob) of JSON-line message files")
    p.add_argument("--base", required=True, help="table store root on shared storage")
    p.add_argument("--checkpoint", help="streaming checkpoint folder (default: under spark.checkpoint.dir)")
    p.add_argument("--bookmarks", help="folder for released STATE bookmarks")
    p.add_argument("--buckets", type=int, default=64)
    p.add_argument("--watch", action="store_true", help="keep polling for new files")
    a = p.parse_args(argv)
    config = {}
    if a.config:
        with open(a.config, encoding="utf-8") as f:
            config = json.load(f)
    spark = configure(SparkSession.builder.appName("tablestream").getOrCreate())
    ckpt = a.checkpoint or f"{checkpoint_dir(spark)}/tablestream-loader"
    loader, run = loader_from_config(spark, config, a.base, buckets=a.buckets, bookmark_path=a.bookmarks)
    loader.run(a.input, checkpoint=ckpt, available_now=not a.watch, **run)


if __name__ == "__main__":
    main()
