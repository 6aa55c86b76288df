"""Declared variables, groups, chunk geometry and experiments."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import Column

from orbgrid.functions.axes import TimeAxis
from orbgrid.functions.healpix import npix
from orbgrid.functions.scalars import invert_sign, to_percent
from orbgrid.operators.mapping import FieldRule, VariableSpec, has_dims, override


def _var(short, long, source=None, stash=None, averaged=None, **kw) -> VariableSpec:
    return VariableSpec(short, long, (FieldRule(source, stash, averaged),), **kw)


def _averaged(*names: str) -> tuple[FieldRule, ...]:
    return tuple(FieldRule(n, averaged=True) for n in names)


# --- fixed values: output variables and the source fields they come from -----
# (short name, long name, source field); a source of None means selected by code.

_SHIFTED = "Hourly mean - time index shifted from half past the hour to the following hour"

SURFACE = (
    _var("psl", "air_pressure_at_mean_sea_level", "air_pressure_at_sea_level"),
    _var("tas", "air_temperature", "air_temperature"),
    _var("clwvi", "atmosphere_mass_content_of_cloud_condensed_water", "m01s02i391", units="kg m-2"),
    _var("clivi", "atmosphere_mass_content_of_cloud_ice", "m01s02i392", units="kg m-2"),
    _var("prw", "atmosphere_mass_content_of_water_vapor", "m01s30i461", units="kg m-2"),
    _var(
        "clt", "cloud_area_fraction", "cloud_area_fraction_assuming_maximum_random_overlap",
        post=to_percent, units="%",
    ),
    _var("uas", "eastward_wind", "x_wind"),
    _var("vas", "northward_wind", "y_wind"),
    VariableSpec(
        "pr", "precipitation_flux",
        _averaged("stratiform_rainfall_flux", "stratiform_snowfall_flux"), ("+",),
        attrs={"notes": f"Combined rain and snow. {_SHIFTED}"},
    ),
    _var(
        "prs", "solid_precipitation_flux", "stratiform_snowfall_flux", averaged=True,
        attrs={"notes": _SHIFTED},
    ),
    _var("huss", "specific_humidity", "specific_humidity"),
    _var("ps", "surface_air_pressure", "surface_air_pressure"),
    _var("hflso", "surface_downward_latent_heat_flux", "surface_upward_latent_heat_flux", post=invert_sign),
    _var("hfsso", "surface_downward_sensible_heat_flux", "surface_upward_sensible_heat_flux", post=invert_sign),
    *(
        _var(short, same, same)
        for short, same in (
            ("rlds", "surface_downwelling_longwave_flux_in_air"),
            ("rldscs", "surface_downwelling_longwave_flux_in_air_assuming_clear_sky"),
            ("rsds", "surface_downwelling_shortwave_flux_in_air"),
            ("rsdscs", "surface_downwelling_shortwave_flux_in_air_assuming_clear_sky"),
            ("ts", "surface_temperature"),
            ("rsdt", "toa_incoming_shortwave_flux"),
            ("rlut", "toa_outgoing_longwave_flux"),
            ("rlutcs", "toa_outgoing_longwave_flux_assuming_clear_sky"),
        )
    ),
    _var("rsut", "toa_outgoing_shortwave_flux", "toa_outgoing_shortwave_flux", stash="m01s01i208"),
    _var(
        "rsutcs", "toa_outgoing_shortwave_flux_assuming_clear_sky",
        "toa_outgoing_shortwave_flux_assuming_clear_sky",
    ),
    _var("rsus", "surface_upwelling_shortwave_flux_in_air", "m01s01i202", post=invert_sign, units="W m-2"),
    _var("rlus", "surface_upwelling_longwave_flux_in_air", "surface_net_downward_longwave_flux", post=invert_sign),
)

SOIL = (_var("mrsol", "mass_content_of_water_in_soil_layer", "moisture_content_of_soil_layer"),)

ON_PRESSURE = (
    _var("ua", "eastward_wind", "x_wind"),
    _var("zg", "geopotential_height", "geopotential_height"),
    _var("va", "northward_wind", "y_wind"),
    _var("hur", "relative_humidity", "relative_humidity", stash="m01s30i206"),
    _var("hus", "specific_humidity", "specific_humidity"),
    _var("ta", "air_temperature", "air_temperature"),
    _var("wa", "upward_air_velocity", "upward_air_velocity"),
)

ON_MODEL_LEVELS = tuple(
    _var(short, long, source, levels_to_pressure=True)
    for short, long, source in (
        ("cli", "mass_fraction_of_cloud_ice_in_air", "mass_fraction_of_cloud_ice_in_air"),
        ("clw", "mass_fraction_of_cloud_liquid_water_in_air", "mass_fraction_of_cloud_liquid_water_in_air"),
        ("qg", "mass_fraction_of_graupel_in_air", "mass_fraction_of_graupel_in_air"),
        ("qr", "mass_fraction_of_rain_in_air", "mass_fraction_of_rain_in_air"),
        ("qs", "mass_fraction_of_snow_water_in_air", "mass_fraction_of_cloud_ice_crystals_in_air"),
    )
)

FOUR_WAY_PRECIPITATION = dict(
    fields=_averaged(
        "convective_rainfall_flux", "convective_snowfall_flux",
        "stratiform_rainfall_flux", "stratiform_snowfall_flux",
    ),
    ops=("+", "+", "+"),
    attrs={"notes": f"Combined rain and snow, convective and stratiform. {_SHIFTED}"},
)
TOTAL_PRECIPITATION = dict(
    fields=(FieldRule(stash="m01s05i216", averaged=False),),
    ops=(),
    attrs={"notes": "Uses instantaneous total precipitation"},
)

# Pressure field that places the model levels.
MODEL_LEVEL_PRESSURE = FieldRule("air_pressure")

AXIS_START, AXIS_END = datetime(2020, 1, 20), datetime(2021, 3, 1)
HOURLY = TimeAxis(AXIS_START, AXIS_END, timedelta(hours=1))
THREE_HOURLY = TimeAxis(AXIS_START, AXIS_END, timedelta(hours=3))

STREAMS_PER_CYCLE = 4
# --- end of fixed values -----------------------------------------------------


def time_chunk(zoom: int, regional: bool = False) -> int:
    """Steps per time chunk: grows fourfold per zoom as the field shrinks."""
    if zoom >= 9:
        return 4 if regional and zoom == 9 else 1
    if zoom == 8:
        return 16
    return 4 ** max(3, 8 - zoom)


def work_chunk(zoom: int, regional: bool = False) -> int:
    """Steps that are coarsened and replaced together: whole time chunks, 64 steps at least.

    The finest zooms have chunks of a step or a few; a folder for each would
    make hundreds of thousands.
    """
    return max(time_chunk(zoom, regional), 64)


def space_chunk(zoom: int, regional: bool = False) -> int:
    """Cells per spatial chunk."""
    if zoom <= 5:
        return npix(zoom)
    if zoom == 6:
        return 4**7
    if zoom == 10:
        return 4**9 if regional else 4**10
    return 4**zoom


@dataclass(frozen=True)
class GroupSpec:
    """Variables that share dimensions, a time axis and a store."""

    name: str
    store: str
    axis: TimeAxis
    dims: tuple[str, ...]
    specs: tuple[VariableSpec, ...]

    def constraint(self) -> Column:
        return has_dims(*self.dims)


@dataclass(frozen=True)
class Experiment:
    key: str
    max_zoom: int
    groups: tuple[GroupSpec, ...]
    regional: bool = False
    first_cycle: datetime = AXIS_START
    metadata: dict[str, str] = field(default_factory=dict)

    def stored_specs(self) -> list[tuple[str, VariableSpec]]:
        return [(g.store, s) for g in self.groups for s in g.specs]


_PLANE = ("time", "latitude", "longitude")


def groups_for(
    surface=SURFACE, model_levels=ON_MODEL_LEVELS, soil: bool = True
) -> tuple[GroupSpec, ...]:
    def dims(level: str) -> tuple[str, ...]:
        return (_PLANE[0], level, *_PLANE[1:])

    return (
        GroupSpec("2d", "PT1H", HOURLY, _PLANE, tuple(surface)),
        *((GroupSpec("2d_depth", "PT1H", HOURLY, dims("depth"), SOIL),) if soil else ()),
        GroupSpec("3d", "PT3H", THREE_HOURLY, dims("pressure"), ON_PRESSURE),
        GroupSpec("3d_ml", "PT3H", THREE_HOURLY, dims("model_level_number"), tuple(model_levels)),
    )


# Experiment keys.
GLOBAL_KEYS = (
    "glm.n2560_RAL3p3.tuned", "glm.n2560_CoMA9_hier_v2", "glm.n1280_GAL9_v2", "glm.n1280_CoMA9",
)
REGIONAL_KEYS = (
    "Africa_km4p4_RAL3P3.n1280_CoMA9", "SAmer_km4p4_RAL3P3.n1280_CoMA9", "SEA_km4p4_RAL3P3.n1280_CoMA9",
    "Africa_km4p4_CoMA9_TBv1.n2560_CoMA9_hier_v2", "SAmer_km4p4_CoMA9_TBv1.n2560_CoMA9_hier_v2",
    "SEA_km4p4_CoMA9_TBv1.n2560_CoMA9_hier_v2", "CTC_km4p4_CoMA9_TBv1.n2560_CoMA9_hier_v2",
)


def experiment(key: str) -> Experiment:
    """Settings of one experiment; the physics in its name picks the overrides."""
    meta = {"simulation": key}
    if key in REGIONAL_KEYS:
        surface = override(SURFACE, {"clwvi": None})
        cloud = override(ON_MODEL_LEVELS, {"qs": None}) if "CoMA9_TBv1" in key else ON_MODEL_LEVELS
        return Experiment(key, 10, groups_for(surface, cloud, soil=False), regional=True, metadata=meta)
    surface, cloud = SURFACE, ON_MODEL_LEVELS
    if key.endswith("GAL9_v2"):
        surface = override(SURFACE, {"pr": FOUR_WAY_PRECIPITATION})
        cloud = override(ON_MODEL_LEVELS, {"qg": None, "qs": None})
    elif "CoMA9" in key:
        surface = override(SURFACE, {"pr": TOTAL_PRECIPITATION})
        cloud = override(ON_MODEL_LEVELS, {"qs": None})
    zoom = 10 if key.startswith("glm.n2560") else 9
    return Experiment(key, zoom, groups_for(surface, cloud), metadata=meta)


EXPERIMENTS: dict[str, Experiment] = {k: experiment(k) for k in (*GLOBAL_KEYS, *REGIONAL_KEYS)}

