"""Cold and warm seconds, shuffle bytes, spill and peak task memory per proof query.

    python tools/measure.py --log <new folder> [--sf 0.1] [--cpus 8] [name ...]

Figures come from Spark's event log, written to the given folder. Prints a markdown table.
"""

from __future__ import annotations

import argparse
import json
import sys
import time
from collections import defaultdict
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


def task_figures(folder: Path) -> dict[str, dict[str, int]]:
    """Sums and peaks of the task metrics by job group, read line by line."""
    groups: dict[int, str] = {}
    figures: dict[str, dict[str, int]] = defaultdict(lambda: defaultdict(int))
    files = sorted(path for path in folder.rglob("*") if path.is_file() and ("events" in path.name or path.name.startswith("local-")))
    for file in files:
        for line in file.open():
            event = json.loads(line)
            if event["Event"] == "SparkListenerJobStart":
                name = event.get("Properties", {}).get("spark.job.description", "")
                groups.update({stage: name for stage in event["Stage IDs"]})
            elif event["Event"] == "SparkListenerTaskEnd" and event.get("Task Metrics"):
                metrics, entry = event["Task Metrics"], figures[groups.get(event["Stage ID"], "")]
                entry["shuffle"] += metrics["Shuffle Write Metrics"]["Shuffle Bytes Written"]
                entry["spill"] += metrics["Disk Bytes Spilled"]
                entry["memory"] = max(entry["memory"], metrics["Peak Execution Memory"])
                entry["tasks"] += 1
    return figures


def main() -> None:
    from dugout.session import build_session
    from dugout.standins import CASES

    parser = argparse.ArgumentParser()
    parser.add_argument("--log", required=True)
    parser.add_argument("--sf", default="0.1")
    parser.add_argument("--cpus", default="8")
    parser.add_argument("names", nargs="*")
    options = parser.parse_args()
    log = Path(options.log)
    log.mkdir(parents=True, exist_ok=True)
    spark = build_session(
        "measure", f"local[{options.cpus}]", spark__sql__shuffle__partitions=options.cpus,
        spark__driver__memory="12g", spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__eventLog__enabled="true", spark__eventLog__dir=log.resolve().as_uri(),
        spark__eventLog__compress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = options.names or list(CASES)
    seconds: dict[str, list[float]] = {}
    for name in names:
        for attempt in ("cold", "warm"):
            spark.sparkContext.setJobDescription(f"{name} {attempt}")
            start = time.perf_counter()
            df = CASES[name].query(spark, f"/root/testdata/sf{options.sf}")
            df.write.format("noop").mode("overwrite").save()
            seconds.setdefault(name, []).append(time.perf_counter() - start)
    spark.stop()
    figures = task_figures(log)
    print("| Query | Cold s | Warm s | Shuffle KB | Spill KB | Peak task MB | Tasks |")
    print("|---|---|---|---|---|---|---|")
    for name in names:
        entry = figures[f"{name} warm"]
        print(
            f"| {name} | {seconds[name][0]:.2f} | {seconds[name][1]:.2f} | {entry['shuffle'] / 1024:.0f} "
            f"| {entry['spill'] / 1024:.0f} | {entry['memory'] / 2**20:.1f} | {entry['tasks']} |"
        )


if __name__ == "__main__":
    main()
