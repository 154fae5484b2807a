"""``spark-submit`` entry: one run over a lake, with an exit code.

``spark-submit orderflume/__main__.py <base> [run_id]``: 0 if the run was published, 1 if a gate or stage ended it, 2 for
wrong arguments. What a gate found is in the run's ``logs``.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from orderflume.plans.pipeline import StageFailure, run_pipeline  # noqa: E402
from orderflume.session import build_session  # noqa: E402


def main(arguments: list[str]) -> int:
    if len(arguments) not in (1, 2):
        print(__doc__, file=sys.stderr)
        return 2
    try:
        ws = run_pipeline(build_session(), *arguments)
    except (StageFailure, FileNotFoundError) as failure:
        print(f"run failed: {failure}", file=sys.stderr)
        return 1
    print(f"published {ws.version}")
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
