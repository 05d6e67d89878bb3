"""Chat formatting: reply trees, their best branches, and a reversible template.

Messages point to the message they reply to. Self-joins double the reach of every pointer:
after k rounds a message knows the ancestor 2^k above it, how many messages lie between, and the sum
of their scores. Leaves are ranked by the score of their whole branch, and the members of a
chosen branch are gathered by following the same pointers from its leaf. The number of joins is logarithmic
in the depth, and no message carries a growing path.

Template: ``<|im_start|>role``, a line feed, the text, ``<|im_end|>`` and a line feed, turn after turn. In
a text, ``<`` followed by any number of backslashes and ``|`` gets one backslash more, so control strings occur only
where the template puts them, and taking one away restores the text; in a role, backslashes, line feeds and ``<`` are escaped. The loss mask gives, turn by turn, the range of characters that
counts; only the texts of ``assistant`` turns do.

Everything is DataFrame and SQL work. Defined results. Null role or text counts as empty. A parent that doesn't exist makes its child a root;
messages in a circle of replies have no root and are left out. Of messages with one id in one tree the first by
parent, score, role and text is taken. Equal scores: the longer branch, then the smaller leaf. A null tree id is a tree of its own. Turns of
a conversation that share a number follow in the order of role and text. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from spendlever.llm.stages import Stages

# Control strings of the template.
START = "<|im_start|>"
END = "<|im_end|>"
LOSS_ROLE = "assistant"

_ESCAPE = r"regexp_replace({0}, '<(\\\\*)[|]', '<$1\\\\|')"
_UNESCAPE = r"regexp_replace({0}, '<\\\\(\\\\*)[|]', '<$1|')"
_ROLE = r"replace(replace(replace({0}, '\\', '\\\\'), '\n', '\\n'), '<', '\\l')"
_ROLE_BACK = r"array_join(transform(split({0}, '\\\\\\\\'), y -> replace(replace(y, '\\n', '\n'), '\\l', '<')), '\\')"


def branches(messages: DataFrame, stages: Stages, best: int = 1) -> DataFrame:
    """(tree_id, branch, message_id, depth) of the members of the ``best`` branches of every tree.

    ``messages`` has tree_id, message_id, parent_id and score.
    """
    now = stages.settle(messages.selectExpr(
        "tree_id", "message_id", "parent_id as above", "1L as depth", "cast(score as double) as total"), "reach")
    leaves = now.select("tree_id", "message_id").join(
        now.selectExpr("tree_id as t", "above as a"), F.expr("tree_id <=> t and message_id = a"), "left_anti")
    # Messages that have reached their root are set aside; only the others are joined again.
    jumps, rooted, rounds = [], now.filter("above is null"), max(1, now.count()).bit_length() + 1
    now = now.filter("above is not null")
    for _ in range(rounds):
        if now.isEmpty():
            break
        jumps.append(now)
        higher = rooted.unionByName(now).selectExpr(
            "tree_id as t", "message_id as m", "above as next", "depth as more", "total as added")
        after = stages.settle(
            now.join(higher, F.expr("tree_id <=> t and above = m"), "left").selectExpr(
                "tree_id", "message_id", "next as above", "depth + coalesce(more, 0L) as depth", "total + coalesce(added, 0D) as total"),
            "reach")
        rooted, now = rooted.unionByName(after.filter("above is null")), after.filter("above is not null")
    rooted = rooted.select("tree_id", "message_id", "depth", "total")
    tips = leaves.join(rooted.selectExpr("tree_id as t", "message_id as m", "depth", "total"), F.expr("tree_id <=> t and message_id = m"))
    ranked = tips.selectExpr(
        "tree_id", "message_id", "row_number() over (partition by tree_id order by total desc, depth desc, message_id) as branch"
    ).filter(f"branch <= {best}")
    members = stages.settle(ranked.select("tree_id", "branch", "message_id"), "members")
    for jump in jumps:
        up = jump.selectExpr("tree_id as t", "message_id as m", "above")
        members = stages.settle(members.union(
            members.join(up, F.expr("tree_id <=> t and message_id = m")).select("tree_id", "branch", "above")).distinct(), "members")
    # A pointer to a message that doesn't exist ends a branch.
    return members.join(
        rooted.selectExpr("tree_id as t", "message_id as m", "depth"), F.expr("tree_id <=> t and message_id = m")
    ).select("tree_id", "branch", "message_id", "depth")


def templated(turns: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row per conversation: keys, ``formatted`` and ``loss`` (range of each turn's characters that count)."""
    parts = turns.selectExpr(
        *keys, f"`{order}` as place", f"concat('{START}', {_ROLE.format('role')}, '\\n') as head", f"{_ESCAPE.format('text')} as body",
        f"role = '{LOSS_ROLE}' as counts")
    parts = parts.selectExpr(
        *keys, "place", f"concat(head, body, '{END}\\n') as turn", f"length(head) - {len(START)} as begin",
        f"length(head) - {len(START)} + if(counts, length(body), 0) as stop")
    return parts.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("place", "turn", "begin", "stop"))).alias("turns")
    ).selectExpr(*keys, "array_join(turns.turn, '') as formatted",
                 "transform(turns, x -> named_struct('begin', x.begin, 'stop', x.stop)) as loss")


def read_back(formatted: DataFrame, keys: list[str]) -> DataFrame:
    """Turns of formatted conversations: ``turns`` (role, text, and the text under the loss mask)."""
    cut = formatted.selectExpr(
        *keys, "formatted", rf"slice(split(formatted, '<[|]im_start[|]>'), 2, greatest(size(split(formatted, '<[|]im_start[|]>')) - 1, 0)) as parts", "loss")
    zipped = cut.selectExpr(*keys, "formatted", "arrays_zip(parts, loss) as pairs")
    role = _ROLE_BACK.format(r"substring_index(x.parts, '\n', 1)")
    rest = f"substring(x.parts, length(substring_index(x.parts, '\\n', 1)) + 2)"
    text = _UNESCAPE.format(f"substring_index({rest}, '{END}', 1)")
    under = _UNESCAPE.format("substring(x.parts, x.loss.begin + 1, x.loss.stop - x.loss.begin)")
    return zipped.selectExpr(
        *keys, "formatted", f"transform(pairs, x -> named_struct('role', {role}, 'text', {text}, 'counted', {under})) as turns")


def conversations_as_trees(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """Linear conversations as reply trees: every row replies to the one before."""
    rows = conversations.selectExpr(
        f"cast(`{id_col}` as bigint) as tree_id", f"`{turn_col}` as turn", "coalesce(role, '') as role", "coalesce(text, '') as text")
    return rows.selectExpr(
        "tree_id", "row_number() over (partition by tree_id order by turn, role, text) as message_id", "role", "text", "0D as score"
    ).selectExpr("tree_id", "message_id", "if(message_id = 1, null, message_id - 1) as parent_id", "role", "text", "score")


def best_conversations(messages: DataFrame, best: int = 1) -> DataFrame:
    """(tree_id, branch, formatted, loss) of the best branches of reply trees.

    ``messages``: tree_id, message_id, parent_id, role, text, score.
    """
    stages = Stages(messages.sparkSession, "chat")
    one = messages.selectExpr("tree_id", "message_id", "parent_id", "coalesce(cast(score as double), 0D) as score",
                              "coalesce(role, '') as role", "coalesce(text, '') as text").groupBy("tree_id", "message_id").agg(
        F.min(F.struct("parent_id", "score", "role", "text")).alias("first"))
    settled = stages.settle(one.select("tree_id", "message_id", "first.*"), "messages")
    members = branches(settled, stages, best)
    turns = members.join(
        settled.selectExpr("tree_id as t", "message_id as m", "role", "text"), F.expr("tree_id <=> t and message_id = m"))
    return templated(turns.select("tree_id", "branch", "depth", "role", "text"), ["tree_id", "branch"], "depth")


def digests(formatted: DataFrame, key: str = "tree_id") -> DataFrame:
    """Counts and digests of formatted conversations, read back from their text and mask."""
    turns = read_back(formatted, [key])
    return turns.selectExpr(
        f"{key} as conv_id", "cast(size(turns) as bigint) as n_turns",
        r"sha2(array_join(transform(turns, x -> concat(x.role, '\n', x.text, '\n')), ''), 256) as turns_sha256",
        "array_join(turns.counted, '') as counted", "cast(length(formatted) as bigint) as formatted_chars",
    ).selectExpr("conv_id", "n_turns", "turns_sha256", "cast(length(counted) as bigint) as loss_chars",
                 "sha2(counted, 256) as loss_sha256", "formatted_chars")
