"""Mappings of the sources, built from a few recurring shapes.

Fixed values: vocabulary IRIs, type and predicate names, and the spellings each source uses. The namespace
of the resources themselves is the caller's (``resource``); ``res:`` stands for it.
"""

from __future__ import annotations

RESOURCE = "https://city.example#"

# Vocabulary namespaces.
VOCABULARY = {
    "bigg": "http://bigg-project.eu/ld/ontology#",
    "foaf": "http://xmlns.com/foaf/0.1/",
    "schema": "https://schema.org/",
    "geo": "http://www.w3.org/2003/01/geo/wgs84_pos#",
    "geosp": "http://www.opengis.net/ont/geosparql#",
    "gn": "http://www.geonames.org/ontology#",
    "saref": "https://saref.etsi.org/core/",
    "s4agri": "https://saref.etsi.org/saref4agri/",
    "s4syst": "https://saref.etsi.org/saref4syst/",
    "s4city": "https://saref.etsi.org/saref4city/",
    "s4bldg": "https://saref.etsi.org/saref4bldg/",
    "ssn": "http://www.w3.org/ns/ssn/",
    "time": "http://www.w3.org/2006/time#",
    "qudt": "https://qudt.org/vocab/unit/",
    "vcard": "http://www.w3.org/2006/vcard/ns#",
}
# The device sources (monthly meters, vegetation, weather, climate) spell two namespaces otherwise.
DEVICE_SPELLING = {"gn": "https://www.geonames.org/ontology#", "qudt": "http://qudt.org/schema/qudt/"}
# Fixed value: buildings and their parts use the older ontology namespace.
CADASTRE_SPELLING = {"bigg": "http://bigg-project.eu/ontology#"}


def document(maps: dict[str, dict], resource: str = RESOURCE, spelling: dict[str, str] | None = None) -> dict:
    return {"prefixes": {**VOCABULARY, **(spelling or {}), "res": resource}, "mappings": maps}


def shape(path: str, subject: str, *rules: tuple[str, str]) -> dict:
    """One mapping entry; ``path`` is ``name`` or ``name/root``."""
    name, slash, root = path.partition("/")
    query = f"$.{name}[*][{root}]" if slash else f"$.{name}[*]"
    return {"sources": [["data.json~jsonpath", query]], "s": subject, "po": [list(rule) for rule in rules]}


def geometry(path: str, subject: str, kind: str = "geosp:Geometry") -> dict:
    return shape(path, subject, ("a", kind), ("geosp:asGeoJSON", "$(geometry.coordinates)"))


def hourly_postal_mapping(resource: str = RESOURCE) -> dict:
    path, point = "consumptions", "$(postalCode)-$(economicSector)-$(tariff)"
    return document({
        "postalCodes": shape(path, "res:PostalCodes-$(postalCode)", ("a", "gn:PostalCode"),
                             ("saref:hasMeasurement", "res:Measurement-$(electricityDeviceId)")),
        "measurement": shape(path, "res:Measurement-$(electricityDeviceId)", ("a", "saref:Measurement"),
                             ("saref:isMeasuredIn", "qudt:KiloW-HR-PER-M2"),
                             ("saref:relatesToProperty", "bigg:EnergyConsumptionGridElectricity"),
                             ("saref:relatesToProperty", "bigg:$(economicSectorUri)")),
        "tariff": shape(path, "res:Tariff-$(tariff)", ("a", "bigg:Tariff"), ("bigg:tariffName", "$(tariff)")),
        "contract": shape(path, "res:ContractedTariff-$(tariff)", ("a", "bigg:ContractedTariff"),
                          ("bigg:hasTariff", "res:Tariff-$(tariff)")),
        "supplyPoint": shape(path, f"res:EnergySupplyPoint-{point}", ("a", "bigg:EnergySupplyPoint"),
                             ("bigg:hasContractedTariff", "res:ContractedTariff-$(tariff)")),
        "device": shape(path, f"res:Device-{point}", ("a", "saref:Device"),
                        ("saref:makesMeasurement", "res:Measurement-$(electricityDeviceId)"),
                        ("saref:measuresProperty", "bigg:EnergyConsumptionGridElectricity"),
                        ("s4syst:connectsAt", f"res:EnergySupplyPoint-{point}")),
    }, resource)


def annual_building_mapping(resource: str = RESOURCE) -> dict:
    """The gas device 'controls' its property where the electricity device 'measures' it; the unit is per
    square metre although stored values are totals. Both are kept as the source states them."""
    maps = {}
    for kind, prop, verb in (
        ("electricity", "EnergyConsumptionGridElectricity", "measuresProperty"),
        ("gas", "EnergyConsumptionGas", "controlsProperty"),
    ):
        measurement = f"res:Measurement-$(REFCAT)-{kind.capitalize()}"
        maps[f"{kind}Measurement"] = shape(
            "consumptions", measurement, ("a", "saref:Measurement"), ("saref:isMeasuredIn", "qudt:KiloW-HR-PER-M2"),
            ("saref:isMeasurementOf", "res:Building-$(REFCAT)"), ("saref:relatesToProperty", f"bigg:{prop}"))
        maps[f"{kind}Device"] = shape(
            "consumptions", f"res:Device-$({kind}DeviceId)", ("a", "saref:Device"),
            ("saref:makesMeasurement", measurement), (f"saref:{verb}", f"bigg:{prop}"))
    return document(maps, resource)


def _building_device(path: str, system: str, device: str, hash_column: str, system_type: str, device_type: str,
                     prop: str, unit: str) -> dict[str, dict]:
    """Building <- deployment -> system -> device -> measurement, all keyed by the cadastral reference."""
    ref, measurement = "$(reference)", f"res:Measurement-$({hash_column})"
    return {
        "buildings": shape(path, f"res:Building-{ref}", ("a", "s4bldg:Building")),
        "deployment": shape(path, f"res:Deployment-{ref}", ("a", "s4agri:Deployment"),
                            ("s4agri:isDeployedAtSpace", f"res:Building-{ref}"),
                            ("ssn:hasDeployment", f"res:System-{system}-{ref}")),
        "system": shape(path, f"res:System-{system}-{ref}", ("a", "s4syst:System"), ("a", f"bigg:{system_type}"),
                        ("s4syst:hasSubSystem", f"res:Device-{device}-{ref}")),
        "device": shape(path, f"res:Device-{device}-{ref}", ("a", "saref:Device"), ("a", f"bigg:{device_type}"),
                        ("saref:makesMeasurement", measurement), ("saref:measuresProperty", f"bigg:{prop}")),
        "measurement": _measurement(path, measurement, hash_column, prop, unit),
    }


def _measurement(path: str, subject: str, hash_column: str, prop: str, unit: str) -> dict:
    return shape(path, subject, ("a", "saref:Measurement"), ("bigg:hash", f"$({hash_column})"),
                 ("saref:relatesToProperty", f"bigg:{prop}"), ("saref:isMeasuredIn", f"qudt:{unit}"))


def monthly_address_mapping(resource: str = RESOURCE) -> dict:
    return document(_building_device(
        "endesa", "Electricity", "Electricity-Endesa", "endesaId", "ElectricitySystem", "ElectricityDevice",
        "EnergyConsumptionGridElectricity", "KiloW-HR"), resource, DEVICE_SPELLING)


def vegetation_mapping(resource: str = RESOURCE) -> dict:
    return document(_building_device(
        "ndvi", "NDVI", "NDVI", "ndviId", "NdviSystem", "NdviDevice", "Ndvi", "PERCENT"), resource, DEVICE_SPELLING)


def _station(devices: dict[str, tuple[str, str, str]]) -> dict[str, dict]:
    """Weather station with devices ``{name: (measurement stem, property, unit)}``, keyed by its position."""
    path, at = "weather", "$(latitude)-$(longitude)"
    system = f"res:System-WeatherStation-{at}"
    maps = {"system": shape(
        path, system, ("a", "s4syst:System"), ("a", "s4agri:WeatherStation"), ("bigg:lat", "$(latitude)"),
        ("bigg:long", "$(longitude)"),
        *[("s4syst:hasSubSystem", f"res:Device-{name}-{at}") for name in devices])}
    for name, (stem, prop, unit) in devices.items():
        measurement = f"res:{stem}-$(weatherId)"
        maps[f"device{name}"] = shape(
            path, f"res:Device-{name}-{at}", ("a", "saref:Device"), ("a", "s4syst:System"),
            ("saref:makesMeasurement", measurement), ("saref:measuresProperty", f"bigg:{prop}"))
        maps[f"measurement{name}"] = _measurement(path, measurement, "weatherId", prop, unit)
    return maps


def weather_mapping(resource: str = RESOURCE) -> dict:
    return document(_station({
        "AirTemperature": ("MeasurementTemperature", "DryBulbTemperature", "K"),
        "RelativeHumidity": ("MeasurementHumidity", "RelativeHumidity", "floatPercentage"),
    }), resource, DEVICE_SPELLING)


def urban_climate_mapping(resource: str = RESOURCE) -> dict:
    return document(_station({"AirTemperature": ("Measurement", "DryBulbTemperature", "K")}), resource, DEVICE_SPELLING)


def tourism_mapping(resource: str = RESOURCE) -> dict:
    space = "res:TouristBuildingSpace-$(huts_type)-$(Número d'inscripció)"
    return document({
        "buildings": shape("huts", "res:Building-$(reference)", ("a", "s4bldg:Building"), ("s4bldg:hasSpace", space)),
        "spaces": shape("huts", space, ("a", "bigg:TouristBuildingSpace"), ("bigg:Category", "$(Categoria)"),
                        ("bigg:Capacity", "$(Total places)"), ("bigg:State", "$(Estat)")),
    }, resource)


def buildings_mapping(resource: str = RESOURCE) -> dict:
    point, ref = "buildings.point/properties", "$(building_gml_id)"
    literals = {
        "startState": "beginLifespanVersion", "state": "conditionOfConstruction", "startConstruction": "beginning",
        "endConstruction": "end", "endState": "endLifespanVersion", "cadasterDetailedUrl": "informationSystem",
        "cadastralId": "reference", "mainUse": "currentUse", "buildingUnits": "numberOfBuildingUnits",
        "dwellings": "numberOfDwellings",
    }
    gross, land = f"res:Measurement-{ref}-$(officialAreaReference)", f"res:Measurement-{ref}-BuiltUpLandArea"
    return document({
        "buildings": shape(
            point, f"res:Building-{ref}", ("a", "s4bldg:Building"),
            *[(f"bigg:{name}", f"$({column})") for name, column in literals.items()],
            ("geosp:hasArea", gross), ("geosp:hasArea", land),
            ("geosp:hasGeometry", f"res:Point-{ref}"), ("geosp:hasGeometry", f"res:Polygon-{ref}")),
        **{name: shape(point, f"res:{stem}-$({column})", ("a", kind), ("geosp:sfContains", f"res:Building-{ref}"))
           for name, stem, column, kind in (
               ("postalCodes", "PostalCodes", "CODPOS", "gn:PostalCode"),
               ("censusTract", "CensusTract", "MUNDISSEC", "gn:parentADM5"),
               ("neighbourhood", "Neighbourhood", "codi_barri", "s4city:Neighbourhood"))},
        "point": geometry("buildings.point", "res:Point-$(properties.building_gml_id)", "geo:Point"),
        "polygon": geometry("buildings.geojson", "res:Polygon-$(properties.building_gml_id)"),
        "grossArea": _area(point, gross, "$(value)", "$(officialAreaReference)"),
        "landArea": _area(point, land, "$(area)", "BuiltUpLandArea"),
    }, resource, CADASTRE_SPELLING)


def _area(path: str, subject: str, value: str, prop: str) -> dict:
    return shape(path, subject, ("a", "saref:Measurement"), ("saref:hasValue", value),
                 ("saref:isMeasuredIn", "qudt:M2"), ("saref:relatesToProperty", f"bigg:{prop}"))


def building_spaces_mapping(resource: str = RESOURCE) -> dict:
    name, ref = "buildingsSpaces", "$(localId)"
    point, land = f"{name}.point/properties", f"res:Measurement-{ref}-BuiltUpLandArea"
    space = f"res:InspireBuildingSpace-{ref}"
    return document({
        "buildings": shape(point, "res:Building-$(building_gml_id)", ("a", "s4bldg:Building"), ("s4bldg:hasSpace", space)),
        "spaces": shape(
            point, space, ("a", "bigg:InspireBuildingSpace"), ("bigg:cadastralLocalId", ref),
            ("bigg:numberOfFloorsAboveGround", "$(numberOfFloorsAboveGround)"),
            ("bigg:numberOfFloorsBelowGround", "$(numberOfFloorsBelowGround)"), ("geosp:hasArea", land),
            ("geosp:hasGeometry", f"res:Point-{ref}"), ("geosp:hasGeometry", f"res:Polygon-{ref}")),
        "point": geometry(f"{name}.point", "res:Point-$(properties.localId)", "geo:Point"),
        "polygon": geometry(f"{name}.geojson", "res:Polygon-$(properties.localId)"),
        "area": _area(f"{name}.geojson/properties", land, "$(area)", "BuiltUpLandArea"),
    }, resource, CADASTRE_SPELLING)


def addresses_mapping(resource: str = RESOURCE) -> dict:
    path, ref = "address.point/properties", "$(building_gml_id)"
    literals = {"addressId": "building_gml_id", "specification": "specification", "streetNumber": "designator",
                "streetName": "street_name", "startState": "beginLifespanVersion"}
    return document({
        "buildings": shape(path, f"res:Building-{ref}", ("a", "s4bldg:Building"), ("vcard:hasAddress", f"res:Address-{ref}")),
        "address": shape(path, f"res:Address-{ref}", ("a", "vcard:Address"),
                         *[(f"bigg:{name}", f"$({column})") for name, column in literals.items()],
                         ("vcard:hasGeo", "res:Point-$(localId)")),
        "point": geometry("address.point", "res:Point-$(properties.localId)", "geo:Point"),
    }, resource)


# Boundary levels: source name, subject stem and id column, types, extra literals, polygon stem,
# and the zone above or below it (stem, id column, types, relation from it to the level).
DISTRICT_TYPES = ("gn:parentADM4", "s4city:District")
BOUNDARIES = {
    "census_tract": dict(
        source="censusTracts", stem="CensusTract", key="MUNDISSEC", types=("gn:parentADM5",),
        literals={"bigg:censusTractId": "SECCIO"}, polygon="Polygon",
        parent=("District", "DISTRICTE", DISTRICT_TYPES, "bigg:hasDivision")),
    "district": dict(
        source="districts", stem="District", key="DISTRICTE", types=DISTRICT_TYPES,
        literals={"bigg:districtId": "DISTRICTE"}, polygon="Polygon",
        parent=("Municipality", "MUNICIPI", ("gn:parentADM3",), "bigg:hasDivision")),
    "municipality": dict(
        source="municipalities", stem="Municipality", key="CODIMUNI", types=("gn:parentADM3",),
        literals={"gn:officialName": "NOMMUNI", "bigg:municipalityId": "CODIMUNI"}, polygon="Polygon", parent=None),
    "neighbourhood": dict(
        source="neighbourhoods", stem="Neighbourhood", key="codi_barri", types=("s4city:Neighbourhood",),
        literals={"bigg:neighbourhoodId": "codi_barri", "gn:officialName": "nom_barri"}, polygon="NeighbourhoodPolygon",
        parent=("District", "codi_districte", DISTRICT_TYPES, "bigg:hasNeighbourhood")),
    "postal_code": dict(
        source="postalCodes", stem="PostalCodes", key="CODPOS", types=("gn:PostalCode",),
        literals={"bigg:postalCodeId": "CODPOS"}, polygon="Polygon", parent=None),
}


def boundary_mapping(level: str, resource: str = RESOURCE) -> dict:
    form = BOUNDARIES[level]
    path, column = f"{form['source']}.geojson", f"$(properties.{form['key']})"
    zone, polygon = f"res:{form['stem']}-{column}", f"res:{form['polygon']}-{column}"
    maps = {"zone": shape(path, zone, *[("a", kind) for kind in form["types"]],
                          *[(name, f"$(properties.{c})") for name, c in form["literals"].items()],
                          ("geosp:hasGeometry", polygon))}
    if form["parent"]:
        stem, key, types, relation = form["parent"]
        maps["parent"] = shape(path, f"res:{stem}-$(properties.{key})", *[("a", kind) for kind in types], (relation, zone))
    maps["polygon"] = geometry(path, polygon)
    return document(maps, resource)
