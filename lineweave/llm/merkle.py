"""A manifest of a dataset as trees of digests, with the proof of every row.

Rows are leaves. In each group they stand in order; every ``FAN`` consecutive nodes become the digest of their digests,
level by level, until one is left, the group's subroot; the subroots, ordered by group, give the root in the same way.

Built bottom-up: a level is one aggregation by (group number, place div FAN) of the level below, and is persisted, each node
with the digests that it covers. Proofs are pushed top-down: each persisted level joins its parents, and each child puts
its own siblings, those left and those right of it, before what its parent inherited. So a proof is an array of
(left, right) steps from leaf to root, and folding a leaf with it is one ``aggregate``.

No group meets in one task: places come from a range partition and the counts of its partitions, nodes are grouped by
three, and levels shrink to a third. What passes through a join is as long as the tree is high.

Defined cases: a null field is ``-`` in a leaf; a null group comes first and is a group; null ids come first in theirs;
rows with one id are ordered by their digests, and equal rows take their places in any order; a group of one row has its
leaf as subroot; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineweave.operators import numbering, tables

FAN = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEP = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the count of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof give."""
    return F.aggregate(proof, leaf, lambda node, step: digest(step["left"], node, step["right"]))


def siblings(proof: Column) -> Column:
    """All digests of a proof, one after another."""
    return F.aggregate(proof, F.lit(""), lambda said, step: F.concat(said, step["left"], step["right"]))


class _Tree:
    """The persisted levels above nodes (tree, place, digest), which hold ``count`` leaves for each tree, and their proofs."""

    def __init__(self, nodes: DataFrame, most: int):
        self.leaves, self.levels, self.paths = nodes, [], []
        below = nodes.where("n > 1").select("tree", "place", "digest", F.col("n").alias("left"))
        while most > 1:
            up = F.floor(F.col("place") / FAN).cast("long")
            kids = F.transform(F.array_sort(F.collect_list(F.struct("place", "digest"))), lambda k: k["digest"])
            level = below.groupBy("tree", up.alias("place")).agg(kids.alias("kids"), F.first("left").alias("left"))
            level = level.withColumn("digest", F.sha2(F.array_join("kids", ""), 256)).withColumn("left", F.floor((F.col("left") + FAN - 1) / FAN).cast("long"))
            level, path = tables.written(level, f"level{len(self.levels) + 1}")
            self.levels.append(level)
            self.paths.append(path)
            below = level.where("left > 1").select("tree", "place", "digest", "left")
            most = -(-most // FAN)

    def tops(self) -> DataFrame:
        """(tree, digest): what remains of each tree."""
        found = self.leaves.where("n = 1").select("tree", "digest")
        for level in self.levels:
            found = found.unionByName(level.where("left = 1").select("tree", "digest"))
        return found

    def proofs(self, above: DataFrame | None = None) -> DataFrame:
        """The leaves with their proofs, which go on with the proof that ``above`` (tree, proof) has for the tree."""
        none = F.expr(f"cast(array() as {STEP})")
        inherited = None  # (tree, place, kids, proof): the level above, with what its nodes pass on
        for level in [*reversed(self.levels), None]:
            nodes = self.leaves.withColumn("end", F.col("n") == 1) if level is None else level.select("tree", "place", "kids", (F.col("left") == 1).alias("end"))
            ends = nodes.where("end").drop("end")
            if above is None:
                ends = ends.withColumn("proof", none)
            else:
                ends = ends.join(above, "tree")
            if inherited is not None:
                ends = ends.unionByName(self._children(nodes.where("not end").drop("end"), inherited))
            if level is None:
                return ends
            inherited, path = tables.written(ends, "proofs")
            self.paths.append(path)

    @staticmethod
    def _children(nodes: DataFrame, parents: DataFrame) -> DataFrame:
        """Each child prepends its siblings to the proof of its parent."""
        up = parents.select("tree", F.col("place").alias("up"), F.col("kids").alias("_run"), F.col("proof").alias("_suffix"))
        at = (F.col("place") % FAN).cast("int")
        left = F.array_join(F.slice("_run", F.lit(1), at), "")
        right = F.array_join(F.slice("_run", at + 2, F.greatest(F.size("_run") - at - 1, F.lit(0))), "")
        step = F.struct(left.alias("left"), right.alias("right"))
        both = nodes.withColumn("up", F.floor(F.col("place") / FAN).cast("long")).join(up, ["tree", "up"])
        return both.withColumn("proof", F.concat(F.array(step), F.col("_suffix"))).drop("up", "_run", "_suffix")


def manifest(leaves: DataFrame, group: str, order: Sequence[str], leaf: str = "leaf") -> DataFrame:
    """Adds subroot, root and proof to rows that have the digest ``leaf``; leaves of a group stand in ``order``, then by digest.

    The columns of ``leaves`` must not be called subroot, root or proof. The tables behind the result's last join stay
    until the application ends; those before are removed.
    """
    keep = leaves.columns
    rows, paths = tables.written(leaves, "leaves")
    keys = [F.col(c).asc_nulls_first() for c in (*order, leaf)]
    rest = [F.col(c).asc_nulls_first() for c in keep if c not in (group, leaf, *order)]
    placed, more = numbering.numbered_within(rows, [group], [*keys, *rest], "_place")
    sizes = placed.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    numbered, named = numbering.numbered(sizes, [F.col(group).asc_nulls_first()], "_tree")
    groups, path = tables.written(numbered.withColumnRenamed(group, "_group"), "groups")
    most, trees = groups.agg(F.max("_n"), F.count(F.lit(1))).first()
    known = placed.join(tables.beside(groups), F.col(group).eqNullSafe(F.col("_group"))).drop("_group")
    names = [F.col(c).alias(f"own_{i}") for i, c in enumerate(keep)]
    nodes = known.select(F.col("_tree").alias("tree"), F.col("_place").alias("place"), F.col("_n").alias("n"), F.col(leaf).alias("digest"), *names)
    nodes, at = tables.written(nodes, "nodes")
    for p in (paths, *more, *named):
        tables.remove(p)
    low = _Tree(nodes, most or 0)
    subroots, _ = tables.written(low.tops(), "subroots")
    high = _Tree(subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"), F.lit(trees).cast("long").alias("n"), "digest"), trees)
    top = high.tops().select("digest").first()
    root = F.lit(top[0] if top else None).cast("string")
    passed, _ = tables.written(high.proofs().select(F.col("place").alias("tree"), F.col("digest").alias("subroot"), "proof"), "passed")
    passed = tables.beside(passed)
    found = low.proofs(passed.select("tree", "proof")).join(passed.select("tree", "subroot"), "tree")
    return found.select(*(F.col(f"own_{i}").alias(c) for i, c in enumerate(keep)), "subroot", root.alias("root"), "proof")


def checked(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, leaf, subroot, root, proof, changed) of a table of documents.

    ``changed`` is the leaf after tampering, which takes the line feeds out of each text whose id has an even crc32; it is
    null where nothing is done, as with a null id.
    """
    value = {c: F.col(c) for c in FIELDS}
    leaf = digest(*(field(value[c]) for c in FIELDS))
    changed = digest(*(field(F.replace(value[c], F.lit("\n"), F.lit("")) if c == "text" else value[c]) for c in FIELDS))
    even = F.crc32(value["doc_id"].cast("string").cast("binary")) % 2 == 0
    leaves = docs.select("doc_id", "source", leaf.alias("leaf"), F.when(even & value["text"].isNotNull(), changed).alias("changed"))
    return manifest(leaves, "source", ["doc_id"]).drop("source")


def verdicts(found: DataFrame) -> DataFrame:
    """The columns of the contract: each proof's digest, the root that the row folds to, and whether it is the root."""
    folded = fold(F.coalesce("changed", "leaf"), F.col("proof"))
    rows = found.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings(F.col("proof")), 256).alias("proof_sha256"), folded.alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


# The same trees over lists: a list of digests for each source and level, and the steps of a leaf from slices of them.
ORACLE = r"""
with recursive fields as (
    select doc_id, source, text, list_transform([doc_id::varchar, source, lang, n_chars::varchar], lambda v: coalesce(strlen(v)::varchar || ':' || v, '-')).list_aggregate('string_agg', '') as head,
        list_reduce(list_concat([4294967295::bigint], list_transform(string_split(coalesce(doc_id::varchar, ''), ''), lambda c: ascii(c)::bigint)),
            lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], list_transform(range(8), lambda k: k)), lambda r, k: case when r % 2 = 1 then xor(r // 2, 3988292384) else r // 2 end)) as crc
    from documents
), hashed as (
    select *, sha256(head || coalesce(strlen(text)::varchar || ':' || text, '-')) as leaf,
        case when xor(crc, 4294967295) % 2 = 0 and doc_id is not null
            then sha256(head || coalesce(strlen(replace(text, chr(10), ''))::varchar || ':' || replace(text, chr(10), ''), '-')) end as changed
    from fields
), low as (
    select source, 0 as level, list(leaf order by doc_id nulls first, leaf) as nodes from hashed group by source
    union all
    select source, level + 1, list_transform(range((len(nodes) + 2) // 3), lambda i: sha256(array_to_string(nodes[3 * i + 1 : 3 * i + 3], ''))) from low where len(nodes) > 1
), tops as (
    select source, nodes[1] as subroot, row_number() over (order by source nulls first) - 1 as place from low where len(nodes) = 1
), high as (
    select 0 as level, list(subroot order by place) as nodes from tops
    union all
    select level + 1, list_transform(range((len(nodes) + 2) // 3), lambda i: sha256(array_to_string(nodes[3 * i + 1 : 3 * i + 3], ''))) from high where len(nodes) > 1
), placed as (
    select h.*, t.place as top, t.subroot, row_number() over (partition by h.source order by h.doc_id nulls first, h.leaf, h.changed nulls first) - 1 as place
    from hashed h join tops t on h.source is not distinct from t.source
), steps as (
    select p.doc_id, p.leaf, p.place, p.top, low.level, low.nodes, p.place // (3 ** low.level)::bigint as i from placed p join low on low.source is not distinct from p.source where len(low.nodes) > 1
    union all
    select p.doc_id, p.leaf, p.place, p.top, 100 + high.level, high.nodes, p.top // (3 ** high.level)::bigint from placed p cross join high where len(high.nodes) > 1
), proofs as (
    select top, place, list([array_to_string(nodes[i - i % 3 + 1 : i], ''), array_to_string(nodes[i + 2 : i - i % 3 + 3], '')] order by level) as proof from steps group by top, place
), folded as (
    select p.*, (select max(nodes[1]) from high where len(nodes) = 1) as root, coalesce(array_to_string(list_transform(f.proof, lambda s: s[1] || s[2]), ''), '') as said,
        coalesce(list_reduce(list_concat([[coalesce(p.changed, p.leaf), '']], f.proof), lambda a, s: [sha256(s[1] || a[1] || s[2]), ''])[1], p.changed, p.leaf) as folded_root
    from placed p left join proofs f using (top, place)
)
select doc_id, leaf, subroot, root, sha256(said) as proof_sha256, folded_root, folded_root = root as verified from folded
"""
