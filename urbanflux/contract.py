"""Fixed values of the data contract.

Column names, limits, labels and weights below are part of the results that
users compare against, so they are stated here once and as plain text.
"""

from __future__ import annotations

# --- fixed values: raw column -> contract column, street-hail ("yellow") files
YELLOW_COLUMNS = {
    "tpep_pickup_datetime": "fecha_inicio",
    "tpep_dropoff_datetime": "fecha_fin",
    "PULocationID": "origen_id",
    "DOLocationID": "destino_id",
    "passenger_count": "num_pasajeros",
    "trip_distance": "distancia",
    "fare_amount": "tarifa_base",
    "extra": "extra",
    "mta_tax": "mta_tax",
    "tip_amount": "propina",
    "tolls_amount": "peajes",
    "ehail_fee": "ehail_fee",
    "improvement_surcharge": "recargo_mejora",
    "congestion_surcharge": "recargo_congestion",
    "total_amount": "precio_total",
    "payment_type": "tipo_pago",
    "RatecodeID": "codigo_tarifa",
    "trip_type": "tipo_viaje",
}

# --- fixed values: raw column -> contract column, ride-hail ("fhvhv") files
FHVHV_COLUMNS = {
    "hvfhs_license_num": "plataforma",
    "dispatching_base_num": "base_despacho",
    "originating_base_num": "base_origen",
    "request_datetime": "fecha_solicitud",
    "on_scene_datetime": "fecha_llegada_conductor",
    "pickup_datetime": "fecha_inicio",
    "dropoff_datetime": "fecha_fin",
    "PULocationID": "origen_id",
    "DOLocationID": "destino_id",
    "trip_miles": "distancia",
    "trip_time": "duracion_seg",
    "base_passenger_fare": "tarifa_base",
    "tolls": "peajes",
    "bcf": "black_car_fund",
    "sales_tax": "impuesto_ventas",
    "congestion_surcharge": "recargo_congestion",
    "airport_fee": "recargo_aeropuerto",
    "cbd_congestion_fee": "recargo_cbd",
    "payment_type": "tipo_pago",
    "tips": "propina",
    "driver_pay": "pago_conductor",
    "shared_request_flag": "solicitud_compartida",
    "shared_match_flag": "viaje_compartido",
    "access_a_ride_flag": "access_a_ride",
    "wav_request_flag": "wav_solicitado",
    "wav_match_flag": "wav_realizado",
}

SERVICE_COLUMNS = {"yellow": YELLOW_COLUMNS, "fhvhv": FHVHV_COLUMNS}
SERVICE_LABELS = {"yellow": "Yellow Taxi", "fhvhv": "VTC"}

TIMESTAMP_COLUMNS = ("fecha_inicio", "fecha_fin", "fecha_solicitud")
FLOAT_COLUMNS = (
    "distancia", "duracion_min", "duracion_seg", "espera_min", "tarifa_base",
    "precio_total", "peajes", "propina", "precio_base", "precio_total_est",
)
INT_COLUMNS = ("origen_id", "destino_id", "num_pasajeros")

CORE_COLUMNS = (
    "fecha_inicio", "fecha_fin", "origen_id", "destino_id", "distancia",
    "propina", "tipo_pago",
)
# surcharges that rebuild the ride-hail total
PRICE_COMPONENTS = (
    "peajes", "black_car_fund", "impuesto_ventas", "recargo_congestion",
    "recargo_aeropuerto", "recargo_cbd",
)
YELLOW_DROPPED = (
    "tarifa_base", "precio_total", "peajes", "extra", "mta_tax",
    "recargo_mejora", "recargo_congestion", "ehail_fee", "codigo_tarifa",
    "tipo_viaje",
)
FHVHV_KEPT = (
    "fecha_inicio", "fecha_fin", "origen_id", "destino_id", "distancia",
    "duracion_min", "velocidad_mph", "tipo_vehiculo", "precio_base",
    "precio_total_est", "espera_min", "propina", "tipo_pago",
)

# --- fixed values: quality limits (open or closed as each rule states)
UNKNOWN_ZONES = (264, 265)
DISTANCE_LIMITS = (0.1, 200.0)
DURATION_LIMITS = (1.0, 180.0)
FARE_MAX = 500.0
PASSENGER_MAX = 8
TRIP_SECONDS_LIMITS = (30, 6 * 3600)
WAIT_MAX = 120.0
SPEED_BAND = (2.0, 85.0)
SUCCESS_WAIT = 10.0
DENSE_TRAFFIC_MPH = 10.0
FALSE_ZERO_PRICE = 10.0
WEATHER_FLAG = 0.1

# --- fixed values: time bands as (first hour, past-the-end hour, two labels)
TIME_BANDS = (
    (0, 6, "Madrugada", "madrugada"),
    (6, 12, "Mañana", "manana"),
    (12, 16, "Mediodia", "mediodia"),
    (16, 20, "Tarde", "tarde"),
    (20, 24, "Noche", "noche"),
)
BAND_ALIASES = {"medio dia": "mediodia", "medio-dia": "mediodia"}

WEEKDAYS_EN = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
WEEKDAYS_ES = ("Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo")

# --- fixed values: seasons by month, remaining months are autumn
SEASONS = {"Invierno": (12, 1, 2), "Primavera": (3, 4, 5), "Verano": (6, 7, 8)}
SEASON_OTHER = "Otoño"

# --- fixed values: zone classes by keyword in the zone name
AIRPORT_KEYWORDS = ("JFK", "LaGuardia")
BUSINESS_KEYWORDS = ("Midtown Center", "Midtown East")
LEISURE_KEYWORDS = ("Times Square/Theatre District", "East Village", "Union Square")
PREMIUM_KEYWORDS = ("Upper East Side North", "Upper East Side South", "East Chelsea")

# --- fixed values: city-event impact
EVENT_MASSIVE_ATTENDANCE = 5000
EVENT_MEDIUM_ATTENDANCE = 1000
EVENT_MASSIVE_WORDS = ("PARADE", "MARATHON", "STREET FESTIVAL", "PLAZA EVENT")
EVENT_MEDIUM_WORDS = ("STREET FAIR", "SPECIAL EVENT")
EVENT_PRIORITY = {"Masivo": 3, "Medio": 2, "Pequeño": 1, "No hay": 0}
NO_EVENT = "No hay"

WEATHER_BOROUGHS = ("Manhattan", "Brooklyn", "Queens", "Bronx", "Staten Island", "EWR")

VEHICLE_SYNONYMS = {
    "1": "Yellow Taxi", "2": "VTC", "yellow": "Yellow Taxi", "taxi": "Yellow Taxi", "vtc": "VTC",
}

# --- fixed values: model and report parameters
LAGS = (1, 2, 3, 6, 12, 24)
LAGS_REQUIRED = (1, 2, 3)
LAGS_FILLED = (6, 12, 24)
ROLLING = (3, 24)
TIME_SPLIT = (0.70, 0.85)
GOOD_ZONE_QUANTILE = 0.67
LEVEL_QUANTILES = (0.33, 0.66)
INDEX_WEIGHTS = {"propina": 0.4, "num_pasajeros": 0.3, "viajes": 0.3}
POTENTIAL_HIGH = 0.6
BASELINE_RATE = 0.33
ACCEPT_SCORE = 0.55
ACCEPT_WEIGHTS = {"propina": 0.45, "velocidad": 0.25, "retorno": 0.30}
TIP_SCALE = 4.0
SPEED_SCALE = 20.0
KMH_TO_MPH = 0.621
STD_PROXY = 0.1
TEST_MONTHS = (10, 11)
VAL_MONTHS = (9,)

CONTEXT_KEYS = ("origen_id", "mes_num", "dia_semana", "hora")
# most specific first; an empty table falls through to the next level
CONTEXT_LEVELS = (
    ("zona + mes + dia_semana + hora", ("origen_id", "mes_num", "dia_semana", "hora")),
    ("zona + mes + hora", ("origen_id", "mes_num", "hora")),
    ("zona + dia_semana + hora", ("origen_id", "dia_semana", "hora")),
    ("zona + hora", ("origen_id", "hora")),
    ("zona", ("origen_id",)),
)
NO_CONTEXT = "sin contexto"

CONTEXT_P2_MEANS = (
    "n_viajes", "espera_media", "hora_sen", "hora_cos", "temp_c", "precipitation",
    "viento_kmh", "lluvia", "nieve", "es_festivo", "num_eventos", "oferta_inferida",
    "tasa_historica", "demanda_p1",
)
CONTEXT_P5_MEANS = (
    "num_pasajeros", "distancia", "duracion_min", "velocidad_mph", "precio_base",
    "precio_total_est", "espera_min", "temp_c", "precipitation", "viento_kmh", "lluvia",
    "nieve", "es_festivo", "num_eventos", "es_fin_semana", "hora_sen", "hora_cos",
    "rentabilidad_base_min", "trafico_denso",
)
CONTEXT_P5_MODES = (
    "tipo_vehiculo", "origen_zona", "origen_barrio", "evento_tipo", "franja_horaria",
)

P1_FEATURES = (
    "origen_id", "hora", "dia_semana", "dia_mes", "mes_num", "es_finde", "demanda",
    "lag_1h", "lag_2h", "lag_3h", "lag_6h", "lag_12h", "lag_24h",
    "roll_mean_3h", "roll_std_3h", "roll_mean_24h", "roll_std_24h", "media_hist",
    "temp_c", "precipitation", "viento_kmh", "velocidad_mph", "lluvia", "nieve",
    "es_festivo", "num_eventos",
)
P2_FEATURES = (
    "origen_id", "hora", "dia_semana", "es_finde", "hora_sen", "hora_cos", "mes_num",
    "temp_c", "precipitation", "viento_kmh", "lluvia", "nieve", "es_festivo",
    "num_eventos", "oferta_inferida", "tasa_historica", "demanda_p1", "n_viajes",
    "espera_media",
)
P4_NUMERIC = (
    "temp_c", "precipitation", "viento_kmh", "lluvia", "nieve", "hay_lluvia", "hay_nieve",
    "es_festivo", "num_eventos", "dia_semana", "es_fin_semana", "hora_sen", "hora_cos",
)
P4_CATEGORICAL = ("tipo_vehiculo", "franja_horaria")
P5_NUMERIC = (
    "precio_base", "precio_total_est", "espera_min", "temp_c", "precipitation",
    "viento_kmh", "lluvia", "nieve", "es_festivo", "num_eventos", "mes_num", "hora",
    "dia_semana", "es_fin_semana", "hora_sen", "hora_cos", "num_pasajeros", "distancia",
    "duracion_min", "velocidad_mph", "rentabilidad_base_min", "trafico_denso",
)
P5_CATEGORICAL = CONTEXT_P5_MODES

CORRELATION_COLUMNS = (
    "distancia", "propina", "precio_base", "temp_c", "precipitation", "viento_kmh",
    "duracion_min", "velocidad_mph", "precio_total_est", "espera_min", "num_eventos",
    "mes_num", "lluvia", "nieve", "es_festivo", "hora_inicio", "dia_semana", "es_finde",
    "duracion_calc_min", "ingreso_por_milla", "ingreso_por_min",
)

# --- fixed values: defaults when a context column is missing
CONTEXT_DEFAULTS_P2 = {
    "oferta_inferida": 1.0, "tasa_historica": 1.0, "espera_media": 0.0, "temp_c": 15.0,
    "precipitation": 0.0, "viento_kmh": 10.0, "lluvia": 0.0, "nieve": 0.0,
    "es_festivo": 0.0, "num_eventos": 0.0,
}
CONTEXT_DEFAULTS_P5 = {
    "temp_c": 15.0, "precipitation": 0.0, "viento_kmh": 10.0, "lluvia": 0.0, "nieve": 0.0,
    "es_festivo": 0.0, "num_eventos": 0.0, "num_pasajeros": 1.0, "distancia": 3.0,
    "espera_min": 1.0, "duracion_min": 10.0, "trafico_denso": 0.0,
    "rentabilidad_base_min": 1.0, "origen_zona": "desconocido",
    "origen_barrio": "desconocido", "evento_tipo": "No hay", "franja_horaria": "Tarde",
}
EXTRA_PRICE_DEFAULT = 2.0
