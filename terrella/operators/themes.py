"""The theme catalogue, and the filter language that selects features into themes."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrella.functions import tags as T

#: The columns before and after the typed ones.
BASE_FIRST, BASE_LAST = ("osm_id", "osm_type", "country", "state", "state_iso"), ("tags", "bbox", "geometry")

_KINDS = {"n": "node", "w": "way", "r": "relation"}


@dataclass(frozen=True)
class TypedColumn:
    """A column promoted from the tag at key; without a key, from that of its own name."""

    name: str
    key: str = ""
    kind: str = "string"


@dataclass(frozen=True)
class Theme:
    name: str
    filter: str
    geometries: tuple[str, ...]
    columns: tuple[TypedColumn, ...]

    @property
    def schema(self) -> str:
        """The DDL of a theme's table."""
        typed = ", ".join(f"`{c.name}` {c.kind}" for c in self.columns)
        return f"osm_id bigint, osm_type string, country string, state string, state_iso string, {typed}, tags map<string,string>, bbox struct<xmin:float,ymin:float,xmax:float,ymax:float>, geometry binary"

    def typed(self, tags: str = "tags") -> list[Column]:
        return [T.tag(tags, c.key or c.name, c.kind).alias(c.name) for c in self.columns]


#: Each theme's name, filter, geometry kinds and typed columns.
THEMES: dict[str, Theme] = {
    t.name: t
    for t in (
        Theme(
            "buildings",
            "wr/building",
            ("polygon",),
            (
                TypedColumn("building"),
                TypedColumn("name"),
                TypedColumn("levels", "building:levels", "int"),
                TypedColumn("height", "height", "double"),
                TypedColumn("addr_street", "addr:street"),
                TypedColumn("addr_housenumber", "addr:housenumber"),
                TypedColumn("addr_postcode", "addr:postcode"),
                TypedColumn("addr_city", "addr:city"),
                TypedColumn("operator"),
                TypedColumn("start_date"),
            ),
        ),
        Theme(
            "roads",
            "w/highway",
            ("linestring",),
            (
                TypedColumn("highway"),
                TypedColumn("name"),
                TypedColumn("ref"),
                TypedColumn("oneway"),
                TypedColumn("surface"),
                TypedColumn("maxspeed"),
                TypedColumn("lanes", "lanes", "int"),
                TypedColumn("bridge"),
                TypedColumn("tunnel"),
                TypedColumn("access"),
                TypedColumn("bicycle"),
                TypedColumn("foot"),
                TypedColumn("motor_vehicle"),
            ),
        ),
        Theme(
            "railways",
            "nwr/railway",
            ("point", "linestring"),
            (
                TypedColumn("railway"),
                TypedColumn("name"),
                TypedColumn("ref"),
                TypedColumn("operator"),
                TypedColumn("gauge", "gauge", "int"),
                TypedColumn("electrified"),
                TypedColumn("usage"),
                TypedColumn("service"),
            ),
        ),
        Theme(
            "waterways",
            "w/waterway",
            ("linestring",),
            (
                TypedColumn("waterway"),
                TypedColumn("name"),
                TypedColumn("width", "width", "double"),
                TypedColumn("intermittent"),
                TypedColumn("tunnel"),
            ),
        ),
        Theme(
            "water",
            "wr/natural=water wr/water",
            ("polygon",),
            (
                TypedColumn("water"),
                TypedColumn("natural"),
                TypedColumn("name"),
                TypedColumn("intermittent"),
                TypedColumn("salt"),
            ),
        ),
        Theme(
            "landuse",
            "wr/landuse",
            ("polygon",),
            (
                TypedColumn("landuse"),
                TypedColumn("name"),
                TypedColumn("operator"),
            ),
        ),
        Theme(
            "natural_areas",
            "wr/natural",
            ("polygon",),
            (
                TypedColumn("natural"),
                TypedColumn("name"),
                TypedColumn("wetland"),
            ),
        ),
        Theme(
            "natural_features",
            "n/natural",
            ("point",),
            (
                TypedColumn("natural"),
                TypedColumn("name"),
                TypedColumn("ele", "ele", "double"),
                TypedColumn("prominence", "prominence", "double"),
            ),
        ),
        Theme(
            "places",
            "n/place",
            ("point",),
            (
                TypedColumn("place"),
                TypedColumn("name"),
                TypedColumn("population", "population", "int"),
                TypedColumn("admin_level", "admin_level", "int"),
                TypedColumn("capital"),
                TypedColumn("is_in"),
            ),
        ),
        Theme(
            "boundaries",
            "r/boundary=administrative",
            ("polygon",),
            (
                TypedColumn("boundary"),
                TypedColumn("admin_level", "admin_level", "int"),
                TypedColumn("name"),
                TypedColumn("border_type"),
                TypedColumn("iso3166_1", "ISO3166-1"),
                TypedColumn("iso3166_2", "ISO3166-2"),
            ),
        ),
        Theme(
            "pois",
            "n/amenity n/shop n/tourism n/leisure n/office n/healthcare",
            ("point",),
            (
                TypedColumn("amenity"),
                TypedColumn("shop"),
                TypedColumn("tourism"),
                TypedColumn("leisure"),
                TypedColumn("office"),
                TypedColumn("healthcare"),
                TypedColumn("name"),
                TypedColumn("brand"),
                TypedColumn("operator"),
                TypedColumn("website"),
                TypedColumn("opening_hours"),
                TypedColumn("phone"),
                TypedColumn("cuisine"),
            ),
        ),
        Theme(
            "amenities_polygons",
            "wr/amenity wr/shop wr/tourism wr/leisure wr/office wr/healthcare",
            ("polygon",),
            (
                TypedColumn("amenity"),
                TypedColumn("shop"),
                TypedColumn("tourism"),
                TypedColumn("leisure"),
                TypedColumn("office"),
                TypedColumn("healthcare"),
                TypedColumn("name"),
                TypedColumn("brand"),
                TypedColumn("operator"),
                TypedColumn("website"),
                TypedColumn("opening_hours"),
                TypedColumn("phone"),
                TypedColumn("cuisine"),
            ),
        ),
        Theme(
            "power",
            "nwr/power",
            ("point", "linestring", "polygon"),
            (
                TypedColumn("power"),
                TypedColumn("name"),
                TypedColumn("voltage", "voltage", "int"),
                TypedColumn("frequency", "frequency", "double"),
                TypedColumn("operator"),
                TypedColumn("cables", "cables", "int"),
            ),
        ),
        Theme(
            "aeroways",
            "nwr/aeroway",
            ("point", "linestring", "polygon"),
            (
                TypedColumn("aeroway"),
                TypedColumn("name"),
                TypedColumn("iata"),
                TypedColumn("icao"),
                TypedColumn("ref"),
                TypedColumn("surface"),
            ),
        ),
        Theme(
            "barriers",
            "nw/barrier",
            ("point", "linestring"),
            (
                TypedColumn("barrier"),
                TypedColumn("name"),
                TypedColumn("access"),
                TypedColumn("height", "height", "double"),
                TypedColumn("material"),
            ),
        ),
        Theme(
            "public_transport",
            "n/public_transport n/highway=bus_stop n/railway=station,halt,tram_stop,subway_entrance",
            ("point",),
            (
                TypedColumn("public_transport"),
                TypedColumn("highway"),
                TypedColumn("railway"),
                TypedColumn("name"),
                TypedColumn("ref"),
                TypedColumn("operator"),
                TypedColumn("network"),
                TypedColumn("bench"),
                TypedColumn("shelter"),
            ),
        ),
    )
}

#: Predicates over the tag map that a theme's features must also meet.
POST_FILTERS = {"natural_areas": lambda tags: F.coalesce(tags["natural"], F.lit("")) != "water"}


def register_theme(theme: Theme, post_filter=None) -> None:
    THEMES[theme.name] = theme
    if post_filter:
        POST_FILTERS[theme.name] = post_filter


def post_filter(theme: str, tags: Column) -> Column:
    """True for themes without a predicate of their own."""
    return POST_FILTERS[theme](tags) if theme in POST_FILTERS else F.lit(True)


def parse_filter(text: str) -> list[tuple[tuple[str, ...], str, tuple[str, ...]]]:
    """Alternatives (object kinds, key, values) of a filter; no values: the key is enough."""
    out = []
    for token in text.split():
        kinds, _, rest = token.partition("/")
        key, _, values = rest.partition("=")
        out.append((tuple(_KINDS[k] for k in kinds), key, tuple(v for v in values.split(",") if v)))
    return out


def tag_filter(text: str, kind: Column, tags: Column) -> Column:
    """The filter as one predicate, which Spark may push and fold."""

    def one(kinds, key, values):
        held = tags[key].isin(*values) if values else F.map_contains_key(tags, key)
        return kind.isin(*kinds) & F.coalesce(held, F.lit(False))

    return reduce(lambda a, b: a | b, [one(*x) for x in parse_filter(text)])


def geometry_filter(theme: Theme, geometry_kind: Column) -> Column:
    """Point, line string or polygon as the theme wants; a multi-part one passes as its part."""
    return F.lower(F.regexp_replace(geometry_kind, "^Multi", "")).isin(*theme.geometries)


def choose(names: list[str] | None, available: list[str], what: str) -> list[str]:
    """A subset in the catalogue's order; unknown names raise."""
    unknown = sorted(set(names or ()) - set(available))
    if unknown:
        raise ValueError(f"unknown {what}: {', '.join(unknown)}")
    return [x for x in available if names is None or x in names]


def theme_rows(features: DataFrame, theme: Theme, kind: str | None = None, geometry_kind: str | None = None) -> DataFrame:
    """features: (osm_id, osm_type, country, state, state_iso, tags, geometry, extent). The theme's table with bbox.

    With kind and geometry_kind the theme's filters apply; features that a source has filtered need none.
    """
    from terrella.functions.geometry import outward_box

    tags = F.col("tags")
    keep = F.col("geometry").isNotNull() & post_filter(theme.name, tags)
    if kind:
        keep = keep & tag_filter(theme.filter, F.col(kind), tags)
    if geometry_kind:
        keep = keep & geometry_filter(theme, F.col(geometry_kind))
    return features.filter(keep).select(*BASE_FIRST, *theme.typed(), "tags", outward_box(F.col("extent")).alias("bbox"), "geometry", "extent")
