"""Constants of the domain that results depend on."""

from __future__ import annotations

# Class bounds, half-open [low, high).
NDVI_CLASSES = [(-1.0, 0.1, 1), (0.1, 0.2, 2), (0.2, 0.3, 3), (0.3, 0.4, 4), (0.40, 0.5, 5), (0.5, 0.55, 6), (0.55, 0.6, 7), (0.60, 0.625, 8), (0.625, 0.65, 9), (0.65, 0.675, 10), (0.675, 0.70, 11), (0.70, 0.725, 12), (0.725, 0.75, 13), (0.75, 1.0, 14)]
NDWI_CLASSES = [(-1.0, -0.15, 1), (-0.15, -0.05, 2), (-0.05, 0.05, 3), (0.05, 0.15, 4), (0.15, 0.20, 5), (0.20, 0.25, 6), (0.25, 0.30, 7), (0.30, 0.325, 8), (0.325, 0.35, 9), (0.35, 0.375, 10), (0.375, 0.40, 11), (0.40, 0.425, 12), (0.425, 0.45, 13), (0.45, 1.0, 14)]
POTENTIAL_CLASSES = [(-9000.0, 0.6, 1), (0.6, 0.9, 2), (0.9, 1.1, 3), (1.1, 1.3, 4), (1.3, 9000.0, 5)]
WEED_CLASSES = [(-10.0, 0.0, 2), (0.0, 10.0, 1)]
HARVESTED = {"NDVI": [1, 2, 3], "NDWI": []}
CRITICAL_WEED_PERCENT = 15.0

# Expected index by age, from the fifth power of the age in days down to the constant, by region and index.
POTENTIAL = {
    ("MX07", "NDRE"): [0.000000000000098, -0.000000000051161, -0.000000012525467, 0.000005959336438, 0.000739203312554, 0.199493195410753],
    ("MX07", "NDWI"): [-0.000000000000268, 0.000000000365123, -0.000000187095158, 0.000037974035589, -0.001211159730837, -0.103648224595588],
    ("MX06", "NDRE"): [-0.000000000000656, 0.000000000626723, -0.000000228534347, 0.000033607870585, -0.000346568129761, 0.221016483453894],
    ("MX06", "NDWI"): [-0.000000000001057, 0.000000001000451, -0.000000355156276, 0.000051721075749, -0.001023270894495, -0.087364430989297],
    ("MX02", "NDRE"): [-0.000000000000676, 0.000000000533030, -0.000000155353342, 0.000017696957070, 0.000556844849307, 0.214562788170895],
    ("MX02", "NDWI"): [-0.000000000001388, 0.000000001173416, -0.000000344287333, 0.000035529951513, 0.000857207455698, -0.087356195373687],
    ("GT", "NDRE"): [-0.000000000000047, 0.000000000019120, 0.000000005022705, -0.000010922540182, 0.003816187604734, 0.149990990306719],
    ("GT", "NDWI"): [-0.000000000001043, 0.000000000994730, -0.000000335383715, 0.000037700434707, 0.001739266187149, -0.134608730808750],
    ("NI", "NDRE"): [0.000000000000096, 0.000000000055232, -0.000000086619735, 0.000018148797811, 0.001270882911438, 0.178959414402129],
    ("NI", "NDWI"): [-0.000000000001572, 0.000000001636878, -0.000000621366573, 0.000092411080706, -0.001803549089450, -0.113900219568478],
}

# Regions with their projection and bounds (west, south, east, north). Mill names map to regions by configuration.
REGIONS = {
    "GT": (32615, (-91.530544, 13.947144, -90.590395, 14.445327)),
    "NI": (32616, (-87.502239, 12.279927, -86.79237, 12.948203)),
    "MX06": (32614, (-98.543185, 21.662828, -98.021094, 22.280718)),
    "MX07": (32614, (-99.353038, 22.437112, -98.49084, 23.31672)),
    "MX02": (32614, (-98.623859, 21.65155, -97.987145, 22.508884)),
}

# Band names, scene classes, nodata codes, cell tokens that mean null.
OPTICAL_BANDS = ["B01", "B02", "B03", "B04", "B05", "B06", "B07", "B08", "B8A", "B09", "B11", "B12", "WVP", "AOT", "SCL"]
SPECTRAL_BANDS = ["B01", "B02", "B03", "B04", "B05", "B06", "B07", "B08", "B8A", "B09", "B11", "B12"]
RADAR_BANDS = ["VV", "VH"]
CLOUD_CLASSES, PREVIEW_CLOUD_CLASSES, PREVIEW_CLEAR_CLASSES, PREVIEW_NODATA = [3, 8, 9, 10], [8, 9, 10], [4, 5, 6, 7], [0, -32768, 255]
INDEX_NODATA, CLASS_NODATA = -32768, -9999
NULL_TOKENS = ["", "-", "—", "N/A", "n/a", "NA", "None", "nan", "#N/A", "#VALUE!", "#REF!"]
PRODUCTS = ["NDVI", "NDWI", "SMART_GROWTH", "WEED"]
PRODUCT_TABLES = {"NDVI": "data_ndvi", "NDWI": "data_ndwi", "SMART_GROWTH": "data_sg", "WEED": "data_maleza"}

# Columns of the parcel table by type.
NUMERIC_COLUMNS = ["area_calculada", "area_cosechada", "area_estimada", "area_potencial", "area_real", "azucar_estimada", "azucar_real", "tch_estimado", "tch_real", "tah_estimado", "tah_real", "ton_estimada", "ton_real", "kg_t_core_zp", "distancia_surco", "ciclo"]
DATE_COLUMNS = ["fecha_inicio", "fecha_fin", "fecha_fin_estimada"]
BOOLEAN_COLUMNS = ["temporada_activa"]
STRING_COLUMNS = ["id_parcela", "ingenio", "company", "ingenio_id", "company_id", "variedad", "textura_suelo", "tipo_riego", "tipo_corte", "tipo_cosecha_estimado", "tipo_cosecha_real", "zafra_st", "zafra"]

# Types that the published tables want for the same column.
PUBLISHED_TYPES = {
    "data_ndvi": {"zafra": "double", "edad": "double", "company_id": "bigint", "ingenio_id": "bigint"},
    "data_ndwi": {"zafra": "bigint", "edad": "bigint", "company_id": "bigint", "ingenio_id": "bigint"},
    "data_sg": {"zafra": "string", "edad": "bigint", "company_id": "bigint", "ingenio_id": "bigint"},
    "data_maleza": {"zafra": "string", "edad": "bigint", "company_id": "bigint", "ingenio_id": "bigint"},
}
