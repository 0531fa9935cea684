"""Chat formatting of reply trees, with DataFrame functions only.

Messages point to their parents. Iterative self-joins double the length of every pointer until it
reaches the root, which gives each message its root, depth and summed score in a logarithmic number
of rounds. Leaves are ranked per tree by that score; only the chosen ones are expanded into paths,
with the same pointer tables, and formatted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airlane.llm.common import stored

START, SAYS, END = "<|turn|>", "<|says|>", "<|done|>"
#: Strings that mark turns in this or in common chat templates; a text that holds one is escaped.
CONTROL = r"([<\[])(\||/?s>|/?INST\]|<?/?SYS>>)"


def escape(text: Column) -> Column:
    r"""Double every backslash, then put one inside every control string. `unescape` reverts it."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, CONTROL, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def linear_messages(turns: DataFrame) -> DataFrame:
    """Rows ``conv_id, turn, role, text`` as messages whose parent is the row before.

    Rows follow ``turn`` (null first), then role and text, so ties and repeated rows have a place.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    place = F.row_number().over(order)
    return turns.select("conv_id", "role", "text", place.alias("place")).select(
        F.struct("conv_id", "place").alias("node"),
        F.when(F.col("place") > 1, F.struct("conv_id", (F.col("place") - 1).alias("place"))).alias("parent"),
        "role", "text", F.lit(0.0).alias("score"))


def _pointers(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Tables of 2**k-th ancestors, and per message its root, depth and score summed along the path.

    A message that has met its root leaves the doubling; a table holds the others only. Messages on a
    cycle, and those below one, never meet a root and are left out.
    """
    known = nodes.select(F.col("node").alias("known"))
    state = stored(nodes.join(known, F.col("parent") == F.col("known"), "left").select(
        "node", F.col("known").alias("up"), F.col("node").alias("top"),
        F.lit(1).cast("long").alias("depth"), F.coalesce("score", F.lit(0.0)).alias("total")), "chat-links")
    reached, tables, before = state.where("up IS NULL"), [], None
    while True:
        pending = state.where("up IS NOT NULL")
        left = pending.count()
        if left in (0, before):
            return tables, reached
        before = left
        tables.append(pending)
        far = reached.unionByName(pending).select(
            F.col("node").alias("up"), F.col("up").alias("far"), F.col("top").alias("far_top"),
            F.col("depth").alias("far_depth"), F.col("total").alias("far_total"))
        state = stored(pending.join(far, "up").select(
            "node", F.col("far").alias("up"), F.col("far_top").alias("top"),
            (F.col("depth") + F.col("far_depth")).alias("depth"),
            (F.col("total") + F.col("far_total")).alias("total")), "chat-links")
        reached = reached.unionByName(state.where("up IS NULL"))


def branches(messages: DataFrame, keep: int = 1) -> DataFrame:
    """The ``keep`` best root-to-leaf paths of every tree, one row per message of a path.

    ``messages``: ``node`` (any orderable type), ``parent``, ``role``, ``text``, ``score``. A path's
    score is the sum of its messages' scores (null counts as 0); equal scores go to the smaller leaf.
    A parent that is not in the table makes its child a root. A node given more than once counts once
    (its smallest row); null nodes and messages on a cycle belong to no path. Other columns are ignored.
    Returns ``root, leaf, rank, path_score, place, role, text``.
    """
    row = F.min(F.struct("parent", "score", "role", "text")).alias("row")
    nodes = stored(messages.where("node IS NOT NULL").groupBy("node").agg(row).select("node", "row.*"), "chat-nodes")
    tables, reached = _pointers(nodes)
    ends = reached.join(tables[0].select(F.col("up").alias("node")).distinct(), "node", "left_anti") if tables else reached
    best = Window.partitionBy("top").orderBy(F.desc("total"), "node")
    chosen = ends.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= keep)
    paths = stored(chosen.select(F.col("top").alias("root"), F.col("node").alias("leaf"), "rank",
                                 F.col("total").alias("path_score"), "node", F.col("depth").alias("place")), "chat-paths")
    for k, step in enumerate(tables):
        added = stored(paths.join(step.select("node", "up"), "node").select(
            "root", "leaf", "rank", "path_score", F.col("up").alias("node"),
            (F.col("place") - (1 << k)).alias("place")), "chat-paths")
        paths = paths.unionByName(added)
    return paths.join(nodes.select("node", "role", "text"), "node").drop("node")


def formatted(paths: DataFrame) -> DataFrame:
    """One conversation per path: ``root, leaf, rank, path_score, n_turns, formatted, loss``.

    A turn is START role SAYS text END with escaped role and text; a null role or text is empty.
    ``loss`` holds one span (``start``, ``stop``: code points of ``formatted``) per turn: that of the
    text if an assistant says it, an empty one otherwise.
    """
    said = escape(F.coalesce("text", F.lit("")))
    turns = (paths
             .withColumn("head", F.concat(F.lit(START), escape(F.coalesce("role", F.lit(""))), F.lit(SAYS)))
             .withColumn("said", said)
             .withColumn("piece", F.concat("head", "said", F.lit(END))))
    before = Window.partitionBy("leaf").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("piece").cast("long")).over(before), F.lit(0)) + F.length("head")
    bears = F.coalesce(F.col("role") == "assistant", F.lit(False))
    turns = turns.withColumn("start", start).withColumn(
        "stop", F.col("start") + F.when(bears, F.length("said")).otherwise(0))
    ordered = F.array_sort(F.collect_list(F.struct("place", "piece", "start", "stop")))
    return turns.groupBy("leaf").agg(
        F.first("root").alias("root"), F.first("rank").alias("rank"), F.first("path_score").alias("path_score"),
        F.count("*").alias("n_turns"), ordered.alias("turns")).select(
        "root", "leaf", "rank", "path_score", "n_turns",
        F.concat_ws("", "turns.piece").alias("formatted"),
        F.transform("turns", lambda t: F.struct(t.start.alias("start"), t.stop.alias("stop"))).alias("loss"))


def read_back(conversations: DataFrame) -> DataFrame:
    """Roles, texts and the text under the loss mask, from ``leaf, formatted, loss`` alone.

    Returns one row per turn: ``leaf, place, role, text, masked`` (null where nothing bears loss).
    """
    pieces = conversations.select("leaf", "loss", F.posexplode(F.split("formatted", r"\Q" + END + r"\E")).alias("at", "piece"))
    # The text ends with END, so that the last element is empty; an empty conversation has none.
    before = Window.partitionBy("leaf").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    begun = F.coalesce(F.sum(F.length("piece").cast("long") + len(END)).over(before), F.lit(0))
    halves = F.split("piece", r"\Q" + SAYS + r"\E")
    span = F.col("loss")[F.col("at")]
    rows = pieces.withColumn("begun", begun).where(F.col("at") < F.size("loss"))
    masked = F.col("piece").substr((span.start - F.col("begun") + 1).cast("int"), (span.stop - span.start).cast("int"))
    return rows.select(
        "leaf", (F.col("at") + 1).alias("place"),
        unescape(F.col("piece").substr(F.lit(len(START) + 1), F.length(halves[0]) - len(START))).alias("role"),
        unescape(halves[1]).alias("text"),
        F.when(span.stop > span.start, unescape(masked)).alias("masked"))
