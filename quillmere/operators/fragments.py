"""Accepted records into graph fragments: each row becomes several nodes and edges in a fixed order."""

from __future__ import annotations

import importlib
from abc import ABC, abstractmethod

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmere.functions import columns as C

#: All fields a fragment may have, in output order; those that are null aren't written.
FIELDS = ("@type", "bronze_reference", "id", "name", "start_date", "end_date", "amount", "received", "form_id", "subject", "rel_type", "predicate", "object")


def fragment(kind: str, reference: Column, **fields: Column) -> Column:
    """A fragment as the common struct."""
    given = {"@type": F.lit(kind), "bronze_reference": reference, **fields}
    return F.struct(*[given.get(f, F.lit(None).cast("string")).alias(f) for f in FIELDS])


class Materializer(ABC):
    """fragments(): array of fragments of a row of named columns; needs: keys whose absence in a record fails it."""

    needs: tuple[str, ...] = ()

    def __init__(self, source: str, run_id: str):
        self.source, self.run_id = source, run_id

    def reference(self, line: Column) -> Column:
        return C.bronze_reference(self.source, self.run_id, line)

    @abstractmethod
    def fragments(self, line: Column) -> Column: ...


class Members(Materializer):
    """Role, person and the relationship between them; with extended, also district, seat and party nodes, dates and named triples."""

    needs = ("person_id", "person_official_first_name", "person_official_last_name", "from_date_time")

    def __init__(self, source: str, run_id: str, extended: bool = False):
        super().__init__(source, run_id)
        self.extended = extended

    def fragments(self, line: Column) -> Column:
        ref, pid, start = self.reference(line), F.col("person_id"), F.col("from_date_time")
        person, role = C.person_uri(pid), C.role_uri(pid, start)
        dates = {"start_date": start, "end_date": F.col("to_date_time")} if self.extended else {}
        out = [
            fragment("MemberOfParliament", ref, id=role, **dates),
            fragment("Person", ref, id=person, name=C.full_name(F.col("person_official_first_name"), F.col("person_official_last_name"))),
            fragment("RELATIONSHIP", ref, subject=person, rel_type=F.lit("HAS_ROLE"), object=role),
        ]
        if not self.extended:
            return F.array(*out)
        place, party = C.slug(F.concat_ws(" ", "constituency_name", "constituency_province_territory_name")), C.slug(F.col("caucus_short_name"))
        district, seat, party_id = F.concat(F.lit("gckg:district/commons/"), place), F.concat(F.lit("gckg:seat/hoc/"), place), F.concat(F.lit("gckg:party/commons/"), party)
        out[2] = fragment("PersonHasRoleMemberOfParliament", ref, subject=person, predicate=F.lit("hasRole"), object=role)
        out += [
            F.when(place.isNotNull(), fragment("FederalElectoralDistrict", ref, id=district, name=F.col("constituency_name"))),
            F.when(place.isNotNull(), fragment("HouseOfCommonsSeat", ref, id=seat, name=F.col("constituency_name"))),
            F.when(party.isNotNull(), fragment("PoliticalParty", ref, id=party_id, name=F.col("caucus_short_name"))),
            F.when(party.isNotNull(), fragment("PersonAssociatedWithPoliticalParty", ref, subject=person, predicate=F.lit("associatedWith"), object=party_id)),
        ]
        return F.filter(F.array(*out), lambda x: x.isNotNull())


class Contributions(Materializer):
    """Recipient, giver, party, district, the contribution itself and the edges that tie them (extension)."""

    needs = ("recipient_id",)

    def fragments(self, line: Column) -> Column:
        ref, rid = self.reference(line), F.col("recipient_id")
        kind = F.when(F.lower("contributor_type").rlike("individual"), F.lit("Person")).otherwise(F.lit("Organization"))
        giver, party, place = C.slug(F.col("contributor_name")), C.slug(F.col("political_party_of_recipient")), C.slug(F.col("electoral_district"))
        recipient = F.concat(F.lit("gckg:Recipient:"), rid)
        giver_id, party_id, place_id = F.concat(F.lit("gckg:contributor/"), giver), F.concat(F.lit("gckg:party/commons/"), party), F.concat(F.lit("gckg:district/commons/"), place)
        who = fragment("Person", ref, id=giver_id, name=F.col("contributor_name"))
        event = F.concat(F.lit("gckg:contribution/"), F.lit(self.run_id), F.lit("/"), line.cast("string"))
        out = [
            fragment("Person", ref, id=recipient, name=F.col("recipient_name")),
            F.when(giver.isNotNull(), who.withField("`@type`", kind)),
            F.when(party.isNotNull(), fragment("PoliticalParty", ref, id=party_id, name=F.col("political_party_of_recipient"))),
            F.when(place.isNotNull(), fragment("FederalElectoralDistrict", ref, id=place_id, name=F.col("electoral_district"))),
            fragment("Contribution", ref, id=event, amount=F.col("monetary_amount"), received=F.col("contribution_received_date"), form_id=F.col("form_id")),
            F.when(giver.isNotNull(), fragment("AgentMadeContribution", ref, subject=giver_id, predicate=F.lit("made"), object=event)),
            fragment("ContributionReceivedByPerson", ref, subject=event, predicate=F.lit("receivedBy"), object=recipient),
            F.when(party.isNotNull(), fragment("PersonAssociatedWithPoliticalParty", ref, subject=recipient, predicate=F.lit("associatedWith"), object=party_id)),
            F.when(place.isNotNull(), fragment("ContributionInFederalElectoralDistrict", ref, subject=event, predicate=F.lit("inDistrict"), object=place_id)),
        ]
        return F.filter(F.array(*out), lambda x: x.isNotNull())


def members(source: str, run_id: str, **options) -> Materializer:
    return Members(source, run_id, **options)


def contributions(source: str, run_id: str, **options) -> Materializer:
    return Contributions(source, run_id, **options)


def load_materializer(dotted: str):
    """The factory that a dotted path names."""
    module, _, name = dotted.rpartition(".")
    return getattr(importlib.import_module(module), name)


def exploded(rows: DataFrame, m: Materializer) -> DataFrame:
    """line, pos, fragment fields: rows (line and slots) in emission order."""
    x = rows.select("line", F.posexplode(m.fragments(F.col("line"))).alias("pos", "f"))
    return x.select("line", "pos", *[F.col(f"f.`{f}`").alias(f) for f in FIELDS])


def as_json(fragments: DataFrame) -> DataFrame:
    """line, pos, value: each fragment's JSON, without null fields."""
    return fragments.select("line", "pos", F.to_json(F.struct(*[F.col(f"`{f}`") for f in FIELDS])).alias("value"))


def nodes(fragments: DataFrame) -> DataFrame:
    return fragments.where("id is not null")


def edges(fragments: DataFrame) -> DataFrame:
    return fragments.where("subject is not null")
