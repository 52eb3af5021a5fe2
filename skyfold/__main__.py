"""Command line for one deployment folder (a shared root).

    python -m skyfold register --root R --pipeline NAME
    python -m skyfold run      --root R --pipeline NAME --batch-time 2026-06-03T20:30:00+00:00
    python -m skyfold marts    --root R [--incremental]
    python -m skyfold expire   --root R
    python -m skyfold state    --root R

Raw payloads are expected as JSON (Lines or, with --multi-line, one
document per file) below ``R/bronze/<dataset>/batch_id=<yyyyMMddTHHmmssZ>/``
(``...ss.ffffffZ`` for a stamp with a fraction of a second).
"""

from __future__ import annotations

import argparse
import datetime as dt
import os

from skyfold.plans import jobs as J
from skyfold.session import build_session


def _ts(text: str | None) -> dt.datetime | None:
    if not text:
        return None
    t = dt.datetime.fromisoformat(text.replace("Z", "+00:00"))
    return t if t.tzinfo else t.replace(tzinfo=dt.timezone.utc)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="skyfold")
    ap.add_argument("command", choices=["register", "run", "marts", "expire", "state"])
    ap.add_argument("--root", required=True, help="deployment folder on shared storage")
    ap.add_argument("--pipeline", default="forecast_and_alert_batches")
    ap.add_argument("--batch-time", help="batch stamp of the run (ISO 8601)")
    ap.add_argument("--as-of", help="'now' of the run (ISO 8601; default: current time)")
    ap.add_argument("--incremental", action="store_true")
    ap.add_argument("--quarantine", action="store_true",
                    help="keep rows breaking the staging key out instead of failing")
    ap.add_argument("--multi-line", action="store_true",
                    help="payloads are one pretty-printed document a file")
    ap.add_argument("--master", default=os.environ.get("SKYFOLD_MASTER"))
    a = ap.parse_args(argv)

    spark = build_session(app=f"skyfold-{a.command}", master=a.master)
    layout = J.Layout(a.root.rstrip("/"))
    as_of = _ts(a.as_of) or dt.datetime.now(dt.timezone.utc)
    if a.command == "register":
        J.register_pipeline(spark, layout, a.pipeline, as_of).show(truncate=False)
    elif a.command == "run":
        if not a.batch_time:
            ap.error("run needs --batch-time")
        J.scheduled_run(spark, layout, a.pipeline, _ts(a.batch_time), as_of,
                        on_key_violation="quarantine" if a.quarantine else "fail",
                        multi_line=a.multi_line).show(truncate=False)
    elif a.command == "marts":
        for model, path in J.build_marts(spark, layout, incremental=a.incremental).items():
            print(model, path)
    elif a.command == "expire":
        report = J.expire(spark, layout, as_of)
        for folder in report["dropped"]:
            print("dropped", folder)
        if report["unparsed"]:
            print(f"kept {report['unparsed']} object(s) without a timestamp, e.g.",
                  report["unparsed_sample"])
    else:
        J.read_state(spark, layout).show(truncate=False)


if __name__ == "__main__":
    main()
