"""A plain-Python model of the job, for brute-force comparison."""

import re
from collections import defaultdict

from logweir.schemas import ACCESS_LOG_PATTERN

LINE = re.compile(ACCESS_LOG_PATTERN, re.ASCII)
PLAIN = 'h - - [01/Jul/1995:00:00:01 -0400] "GET /a HTTP/1.0" 200 6245'


def parse(line, match="full"):
    """The nine fields without the batch, or None."""
    found = LINE.fullmatch(line) if match == "full" else LINE.match(line)
    if not found:
        return None
    host, date, hour, method, path, protocol, status, size = found.groups()
    size = int(size) if re.fullmatch(r"[0-9]+", size) else 0
    if size >= 2**63:
        return None
    return (host, date, int(hour), method, path, protocol, int(status), size)


def daily(rows):
    groups = defaultdict(lambda: [0, 0])
    for b, _, date, _, _, _, _, status, size in rows:
        groups[b, date, status][0] += 1
        groups[b, date, status][1] += size
    return {(*k, *v) for k, v in groups.items()}


def resources(rows):
    groups = defaultdict(lambda: [0, 0, set()])
    for b, host, _, _, _, path, _, _, size in rows:
        group = groups[b, path]
        group[0] += 1
        group[1] += size
        group[2].add(host)
    return {(*k, n, s, len(h)) for k, (n, s, h) in groups.items()}


def hourly(rows):
    groups = defaultdict(lambda: [0, 0, set()])
    for b, host, date, hour, _, _, _, status, _ in rows:
        group = groups[b, date, hour]
        group[1] += 1
        if 400 <= status <= 599:
            group[0] += 1
            group[2].add(host)
    return {(*k, e, n, e / n, len(h)) for k, (e, n, h) in groups.items()}


def lines_frame(spark, lines, file_name="access_log_Jul95"):
    rows = [(i, file_name, line) for i, line in enumerate(lines)]
    return spark.createDataFrame(rows, "id int, file_name string, line string")
