"""Lookup tables of the domain.

Results depend on these values, and for the boxes also on their order (the first box
that holds a point wins).
"""

from __future__ import annotations

# State, lat_min, lat_max, lon_min, lon_max
STATE_BOXES = [
    ("AM", -9.8, 2.2, -73.8, -56.1),
    ("PA", -9.8, 2.6, -58.9, -46.0),
    ("MT", -18.0, -7.3, -61.6, -50.2),
    ("MS", -24.1, -17.2, -58.2, -50.9),
    ("GO", -19.5, -12.4, -53.3, -45.9),
    ("TO", -13.5, -5.2, -50.8, -45.7),
    ("BA", -18.4, -8.5, -46.6, -37.3),
    ("MG", -22.9, -14.2, -51.0, -39.9),
    ("SP", -25.3, -19.8, -53.1, -44.2),
    ("PR", -26.7, -22.5, -54.6, -48.0),
    ("RS", -33.8, -27.1, -57.6, -49.7),
    ("SC", -29.4, -25.9, -53.8, -48.3),
    ("MA", -10.3, -1.0, -48.8, -41.8),
    ("PI", -10.9, -2.7, -45.9, -40.4),
    ("CE", -7.9, -2.8, -41.4, -37.2),
    ("RO", -13.7, -7.9, -66.8, -59.8),
    ("AC", -11.2, -7.1, -73.9, -66.6),
    ("RR", -1.6, 5.3, -64.8, -58.9),
    ("AP", -1.2, 4.5, -54.9, -49.9),
]

# Biome, lat_min, lat_max, lon_min, lon_max
BIOME_BOXES = [
    ("Amazonia", -9.8, 5.3, -73.9, -46.0),
    ("Pantanal", -22.0, -16.0, -58.5, -55.0),
    ("Caatinga", -16.5, -2.8, -44.0, -37.0),
    ("Mata Atlantica", -30.0, -5.0, -48.5, -34.8),
    ("Pampa", -33.8, -28.0, -57.6, -49.7),
    ("Cerrado", -24.0, -2.0, -60.0, -41.0),
]

# Vegetation index and dryness factor by biome
NDVI_BY_BIOME = {
    "Amazonia": 0.8,
    "Cerrado": 0.5,
    "Mata Atlantica": 0.7,
    "Caatinga": 0.3,
    "Pantanal": 0.6,
    "Pampa": 0.45,
    "Desconhecido": 0.5,
}
DRYNESS_BY_BIOME = {
    "Amazonia": 0.6,
    "Cerrado": 1.0,
    "Mata Atlantica": 0.5,
    "Caatinga": 1.1,
    "Pantanal": 0.9,
    "Pampa": 0.7,
    "Desconhecido": 0.7,
}

# Fixed values
UNKNOWN_STATE = "??"
UNKNOWN_BIOME = "Desconhecido"
CONFIDENCE_CODES = {"l": 25.0, "n": 65.0, "h": 95.0}
MIN_CONFIDENCE = 30
DEFAULT_NDVI = 0.5
DEFAULT_DRYNESS = 0.7
COUNTRY_BOX = {"west": -74, "south": -34, "east": -34, "north": 6}
SYNTHETIC_BIOMES = ["Amazonia", "Cerrado", "Pantanal", "Caatinga", "Mata Atlantica"]
SYNTHETIC_STATES = ["PA", "MT", "MS", "GO", "TO", "BA", "MA", "RO", "AM", "SP"]
SYNTHETIC_SATELLITES = ["N", "1", "Aqua", "Terra"]
