"""Questions to a curated graph, put together from fragments and asked as SPARQL texts by vocabulary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sparql import sparql
from .vocabulary import Vocabulary


def _called(**names: str) -> str:
    """Labels of things: _called(who="name") binds the label of ?who to ?name."""
    return " ".join(f"?{thing} skos:prefLabel ?{label} ." for thing, label in names.items())


def _without(pattern: str) -> str:
    return f"FILTER NOT EXISTS {{ {pattern} }}"


def _ask(shown: str, *body: str, tail: str = "") -> str:
    return f"SELECT {shown} WHERE {{ {' '.join(body)} }} {tail}"


#: A claim that links two things, and the grade that was derived for it.
_CLAIM = "?claim v:calculatedConfidence ?grade ; v:aboutObject ?target ; v:aboutSubject ?origin ."
_IDEA = "?idea a v:Concept ."

TEXTS = {
    "concepts": _ask("?idea ?name ?meaning", "?idea skos:definition ?meaning .", _called(idea="name"), _IDEA, tail="ORDER BY ?name"),
    "explain_links": _ask(
        "?who ?how ?why ?strength ?verdict",
        "?proof dct:description ?why ; v:confidence ?weight .",
        _CLAIM.replace("?origin", "{subject}"),
        "?claim v:hasEvidence ?proof . ?target a v:{person} .",
        _called(weight="strength", grade="verdict", target="who"),
        "{subject} ?how ?target FILTER(?how != skos:prefLabel)",
    ),
    "trusted_links": _ask("?from ?how ?to ?verdict", "?origin ?how ?target .", _CLAIM, _called(origin="from", target="to", grade="verdict"), "FILTER(?grade IN (v:ConfidenceType.Corroborated, v:ConfidenceType.Curated))"),
    "links_at": _ask("?from ?to", _CLAIM.replace("?grade", "v:ConfidenceType.{level}"), _called(target="to", origin="from")),
    "unlinked_concepts": _ask("?name", _called(idea="name"), _IDEA, _without("?idea v:influencedBy|v:relatesTo|v:echoesIdeaOf ?source")),
    "appearances": _ask("?partner (COUNT(?meeting) AS ?times)", "?tie v:hasInteraction ?meeting ; v:hasObject ?other .", _called(other="partner"), tail="GROUP BY ?partner ORDER BY DESC(?times)"),
    "undiscussed_concepts": _ask("?name", _called(idea="name"), _IDEA, _without("?show v:discusses ?idea ; a v:Episode")),
    "undated_members": _ask("?person ?body", _called(member="person", club="body"), "?member v:memberOf ?club", _without("?member v:memberOfStartDate ?since")),
    "relations_not_from": _ask("(COUNT(?tie) AS ?ties)", "?tie v:hasSubject ?hub . ?tie a v:Relationship FILTER(?hub != {subject})"),
    "episodes_without_concept": _ask("?show", "?show a v:Episode", _without("?show v:discusses ?idea")),
    "personas_without_crosswalk": _ask("?figure", "?figure a v:Persona", _without("?walk v:aboutEntity ?figure ; a v:CrosswalkNote")),
    "predicate_richness": _ask("?figure (COUNT(DISTINCT ?property) AS ?properties)", "?figure ?property ?value ; a v:Persona", tail="GROUP BY ?figure ORDER BY DESC(?properties)"),
    "members_without_relation": _ask("?member ?club", "?figure v:actsThrough ?member . ?member v:memberOf ?club", _without("?tie v:hasObject ?club ; v:hasSubject ?figure")),
    "human_leaks": _ask("?tie ?human", "?human a v:Human . ?tie v:hasObject|v:hasSubject ?human"),
    "role_reversals": _ask("?tie (COUNT(DISTINCT ?part) AS ?parts)", "?meeting v:subjectRole ?part . ?tie v:hasInteraction ?meeting", tail="GROUP BY ?tie HAVING (COUNT(DISTINCT ?part) > 1)"),
    "relation_types": _ask("?partner ?kind", "?tie v:hasObject ?other ; v:hasRelationshipType ?kind .", _called(other="partner")),
    "multi_guest_episodes": _ask("?show (COUNT(?guest) AS ?guests)", "?show v:hasGuest ?guest", tail="GROUP BY ?show HAVING (COUNT(?guest) > 1)"),
    "episode_type_labels": _ask("?kind ?word", "?kind skos:altLabel ?word ; a v:EpisodeType"),
    "series_members": _ask("?series ?show ?place", "?show v:seriesPosition ?place ; v:isPartOf ?series", tail="ORDER BY ?series ?place"),
    "one_way_parts": _ask("?series ?show", "?show v:isPartOf ?series", _without("?series v:hasPart ?show")),
    "one_way_symmetric": _ask("?one ?other", "?one v:convergesWith ?other", _without("?other v:convergesWith ?one")),
    "subject_rollup": _ask("?top (COUNT(?idea) AS ?ideas)", "?idea dct:subject ?topic . ?topic skos:broader ?top", tail="GROUP BY ?top"),
    "subject_tree": _ask("?top (COUNT(?idea) AS ?ideas)", "?idea dct:subject ?topic . ?topic skos:broader* ?top", tail="GROUP BY ?top"),
    "crosswalk_without_same_as": _ask("?entity ?page", "?walk v:aboutExternalURI ?page ; v:aboutEntity ?entity", _without("?entity owl:sameAs ?page"), _without("?entity v:actsThrough ?body . ?body owl:sameAs ?page")),
    "same_as_without_crosswalk": _ask("?entity ?page", "?entity owl:sameAs ?page", _without("?walk v:aboutExternalURI ?page ; v:aboutEntity ?entity"), _without("?figure v:actsThrough ?entity . ?walk v:aboutEntity ?figure ; v:aboutExternalURI ?page")),
    "created_after_issued": _ask("?show", "?show dct:issued ?out ; dct:created ?made FILTER(?made > ?out)"),
}


def ask_named(graph: DataFrame, name: str, vocabulary: Vocabulary | None = None, **values: str) -> DataFrame:
    """A named question over graph(s, p, o) or a view of one; values fill its {places} (IRIs as <...> or prefixed names)."""
    text = TEXTS[name]
    for k, v in values.items():
        text = text.replace("{" + k + "}", v)
    out = sparql(graph, (vocabulary or Vocabulary()).prefixes() + text)
    if name == "relation_types":
        out = out.groupBy("partner").agg(F.array_join(F.sort_array(F.collect_set("kind")), ",").alias("kinds"))
    return out


def episode_types(manifest: DataFrame, graph: DataFrame, vocabulary: Vocabulary | None = None) -> DataFrame:
    """manifest(..., type) with episode_type: the EpisodeType whose altLabel the row's type is, of several the least IRI; null for none."""
    kinds = ask_named(graph, "episode_type_labels", vocabulary).groupBy("word").agg(F.min("kind").alias("episode_type"))
    return manifest.join(kinds, F.col("type") == F.col("word"), "left").drop("word")
