"""Person identity: registry upsert, deterministic matching, offer to worker links."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hrflow.functions import surrogate_key
from hrflow.operators.components import components
from hrflow.operators.storage import cut_lineage

REGISTRY_KEYS = ("source_system", "source_object", "source_record_id")


def upsert_registry(
    registry: DataFrame, matches: DataFrame, now: dt.datetime, keys: Sequence[str] = REGISTRY_KEYS
) -> DataFrame:
    """Merge resolved matches into the source-to-person registry, as a new version of the registry.

    Known records take the new person, method and confidence and an update time, new ones are inserted
    with a creation time, and registry rows without a match stay as they are.
    """
    stamp = F.lit(now).cast("timestamp")
    old, new = registry.alias("o"), matches.alias("n")
    cond = None
    for k in keys:
        same = F.col(f"o.{k}") == F.col(f"n.{k}")
        cond = same if cond is None else cond & same
    is_new = F.col("o.bridge_person_source_key").isNull()
    matched = F.col(f"n.{keys[0]}").isNotNull()
    take = lambda c: F.when(matched, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))
    id_cols = [F.coalesce(F.col(f"o.{k}"), F.col(f"n.{k}")) for k in keys]
    return old.join(new, cond, "full_outer").select(
        F.coalesce(F.col("o.bridge_person_source_key"), surrogate_key(*id_cols)).alias(
            "bridge_person_source_key"
        ),
        *[c.alias(k) for c, k in zip(id_cols, keys)],
        F.when(matched, F.col("n.resolved_person_key")).otherwise(F.col("o.person_key")).alias("person_key"),
        take("match_method").alias("match_method"),
        take("match_confidence").alias("match_confidence"),
        F.when(is_new, stamp).otherwise(F.col("o.created_at_utc")).alias("created_at_utc"),
        F.when(matched & ~is_new, stamp).otherwise(F.col("o.updated_at_utc")).alias("updated_at_utc"),
    )


def normalised_email(email: Column) -> Column:
    return F.nullif(F.lower(F.trim(email)), F.lit(""))


def normalised_number(number: Column) -> Column:
    return normalised_email(number.cast("string"))


def match_identities(
    incoming: DataFrame, registry: DataFrame, emails: DataFrame, hire_links: DataFrame, numbers: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Deterministic match cascade: known mapping, e-mail, employee number, explicit hire link, otherwise a new person.

    ``incoming`` has the registry keys plus ``email``, and ``employee_number`` where both systems show it;
    ``emails`` has (email, person_key), ``numbers`` (employee_number, person_key) and
    ``hire_links`` (source_record_id, person_key). Numbers are compared like e-mails, without outer blanks and
    case; without ``numbers`` or the column that step is left out. A step that points at more than one person is not
    used to guess: the record goes to the second result, the review cases.

    Each candidate list is first reduced to one row per lookup value with the least and greatest person,
    which tells unique from ambiguous without collecting the candidates.
    """

    def lookup(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
        return df.groupBy(*keys).agg(
            F.min("person_key").alias(f"{name}_person"),
            (F.min("person_key") != F.max("person_key")).alias(f"{name}_ambiguous"),
        )

    known = lookup(registry, REGISTRY_KEYS, "known")
    by_email = lookup(
        emails.select(normalised_email(F.col("email")).alias("_email"), "person_key").where("_email is not null"),
        ["_email"],
        "email",
    )
    by_link = lookup(hire_links, ["source_record_id"], "link")
    steps = ["known", "email", "link"]
    joined = (
        incoming.withColumn("_email", normalised_email(F.col("email")))
        .join(known, list(REGISTRY_KEYS), "left")
        .join(by_email, "_email", "left")
        .join(by_link, "source_record_id", "left")
    )
    if numbers is not None and "employee_number" in incoming.columns:
        steps.insert(2, "number")
        given = numbers.select(normalised_number(F.col("employee_number")).alias("_number"), "person_key")
        by_number = lookup(given.where("_number is not null"), ["_number"], "number")
        joined = joined.withColumn("_number", normalised_number(F.col("employee_number"))).join(by_number, "_number", "left")
    # The first step with any candidate decides, also when it is ambiguous.
    pick = lambda make: F.coalesce(
        *[F.when(F.col(f"{s}_person").isNotNull(), make(s)) for s in steps]
    )
    methods = {"known": "existing_mapping", "email": "email", "number": "employee_number", "link": "hire_link"}
    decided = joined.select(
        *REGISTRY_KEYS,
        F.coalesce(pick(lambda s: F.lit(methods[s])), F.lit("new_person")).alias("match_method"),
        F.coalesce(pick(lambda s: F.col(f"{s}_ambiguous")), F.lit(False)).alias("_ambiguous"),
        F.coalesce(pick(lambda s: F.col(f"{s}_person")), surrogate_key(*REGISTRY_KEYS)).alias(
            "resolved_person_key"
        ),
    )
    resolved = decided.where("not _ambiguous").drop("_ambiguous").withColumn("match_confidence", F.lit(1.0))
    review = decided.where("_ambiguous").select(
        *REGISTRY_KEYS, "match_method", F.lit("more than one person matches").alias("reason")
    )
    return resolved, review


def identity_graph(
    records: DataFrame,
    evidence: Sequence[str],
    single: Sequence[str] = (),
    keys: Sequence[str] = REGISTRY_KEYS,
    known: str | None = None,
) -> DataFrame:
    """Records with the person that their evidence leads to over any number of steps.

    Two records are linked if they agree on one of the ``evidence`` columns (null is no evidence); persons are the
    connected components. Returns the keys, ``person_key``, ``records`` (how many the component has), ``conflict`` and
    ``reason``, the columns in conflict. A component is in conflict if a ``single`` column, for example the employee
    number, has two values in it, or if ``known``, a column of persons already mapped, names two persons; such records
    are for review and are not to be merged. ``person_key`` is the known person, if there is one, else the
    component's smallest record key.

    Linking to the smallest record of each value takes one row per record and column, also where a value is shared
    by a third of all records; no pairs are made.
    """
    used = [*evidence, *[c for c in (*single, known) if c and c not in evidence]]
    nodes = cut_lineage(records.select(surrogate_key(*keys).alias("_node"), *keys, *used), "identity")
    shared = list(evidence) if known is None or known in evidence else [*evidence, known]
    value = lambda c: F.struct(F.lit(c).alias("kind"), F.col(c).cast("string").alias("value"))
    said = nodes.select("_node", F.explode(F.array(*map(value, shared))).alias("_e")).select("_node", "_e.*").where("value is not null")
    first = said.groupBy("kind", "value").agg(F.min("_node").alias("_first"))
    links = said.join(first, ["kind", "value"]).select("_node", "_first")
    named = nodes.join(components(links).withColumnRenamed("node", "_node"), "_node", "left").withColumn(
        "component", F.coalesce("component", "_node")
    )
    checked = [*single, *([known] if known else [])]
    least = [F.min(c).alias(f"_min_{c}") for c in checked]
    most = [F.max(c).alias(f"_max_{c}") for c in checked]
    groups = named.groupBy("component").agg(F.count(F.lit(1)).alias("records"), *least, *most)
    wrong = [F.when(F.col(f"_min_{c}") != F.col(f"_max_{c}"), F.lit(c)) for c in checked]
    reason = F.concat_ws(",", *wrong) if wrong else F.lit("")
    person = F.coalesce(F.col(f"_min_{known}").cast("string"), F.col("component")) if known else F.col("component")
    groups = groups.select(
        "component", person.alias("person_key"), "records", (reason != "").alias("conflict"), F.nullif(reason, F.lit("")).alias("reason")
    )
    return named.select("component", *keys).join(groups, "component").drop("component")


def link_offers_by_window(
    offers: DataFrame, workers: DataFrame, keys: Sequence[str], days: int = 14
) -> DataFrame:
    """Fallback link: an offer and the only worker hired within ``days`` of it who agrees on ``keys``.

    Counting instead of pairing: hires are summed per key and day with their least and greatest worker,
    each daily sum is repeated for the days on which it can be seen, and an offer day that sees exactly
    one worker is a link. Rows grow with ``days``, never with offers times workers.
    """
    hires = (
        workers.where(F.col("hire_date").isNotNull())
        .groupBy(*keys, F.col("hire_date").cast("date").alias("hire_date"))
        .agg(F.min("worker_id").alias("lo"), F.max("worker_id").alias("hi"))
    )
    reach = F.sequence(F.date_sub("hire_date", days), F.date_add("hire_date", days), F.expr("interval 1 day"))
    seen = (
        hires.withColumn("_day", F.explode(reach))
        .groupBy(*keys, "_day")
        .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("hire_date").alias("hire_date"))
        .where("lo = hi")
        .select(*keys, "_day", F.col("lo").alias("worker_id"), "hire_date")
    )
    return offers.withColumn("_day", F.to_date("responded_at")).join(seen, [*keys, "_day"]).drop("_day")
