"""Limits, word lists and tables that results depend on."""

# Accepted range per column.
RANGES = {
    "year": (1985, 2023),
    "price": (1000, 2000000),
    "km": (0, 500000),
    "age_years": (0, 40),
    "engine_size": (0.7, 7.0),
    "doors": (2, 5),
}

# Accepted words per column.
FUEL_TYPES = ["Flex", "Gasolina", "Diesel", "Elétrico", "Híbrido", "GNV"]
TRANSMISSIONS = ["Manual", "Automático", "Automatizado", "CVT"]
CONDITIONS = ["Regular", "Bom", "Ótimo", "Excelente"]
DOORS = [2, 3, 4, 5]

# Brazilian states by region.
REGIONS = {
    "Norte": ["AC", "AP", "AM", "PA", "RO", "RR", "TO"],
    "Nordeste": ["AL", "BA", "CE", "MA", "PB", "PE", "PI", "RN", "SE"],
    "Centro-Oeste": ["DF", "GO", "MT", "MS"],
    "Sudeste": ["ES", "MG", "RJ", "SP"],
    "Sul": ["PR", "RS", "SC"],
}
STATES = sorted(state for states in REGIONS.values() for state in states)
STATE_REGION = {state: region for region, states in REGIONS.items() for state in states}

# Weight of each state in generated locations (normalized at use).
STATE_WEIGHTS = {
    "SP": 0.22, "RJ": 0.08, "MG": 0.10, "RS": 0.05, "PR": 0.05, "BA": 0.07, "SC": 0.03,
    "GO": 0.03, "PE": 0.04, "CE": 0.04, "DF": 0.03, "ES": 0.02, "MT": 0.02, "MS": 0.01,
    "PB": 0.02, "AL": 0.01, "RN": 0.01, "PI": 0.01, "MA": 0.03, "SE": 0.01, "TO": 0.01,
    "AC": 0.005, "AM": 0.02, "RO": 0.01, "RR": 0.005, "AP": 0.005, "PA": 0.02,
}

# Cities that a generated location may take, by state.
STATE_CITIES = {
    "SP": ["São Paulo", "Campinas", "Guarulhos", "São Bernardo do Campo", "Santo André"],
    "RJ": ["Rio de Janeiro", "Niterói", "Duque de Caxias", "Nova Iguaçu", "São Gonçalo"],
    "MG": ["Belo Horizonte", "Uberlândia", "Contagem", "Juiz de Fora", "Betim"],
    "RS": ["Porto Alegre", "Caxias do Sul", "Pelotas", "Canoas", "Santa Maria"],
    "PR": ["Curitiba", "Londrina", "Maringá", "Ponta Grossa", "Cascavel"],
    "BA": ["Salvador", "Feira de Santana", "Vitória da Conquista", "Camaçari", "Juazeiro"],
    "SC": ["Florianópolis", "Joinville", "Blumenau", "São José", "Chapecó"],
    "GO": ["Goiânia", "Aparecida de Goiânia", "Anápolis", "Rio Verde", "Luziânia"],
    "PE": ["Recife", "Jaboatão dos Guararapes", "Olinda", "Caruaru", "Petrolina"],
    "CE": ["Fortaleza", "Caucaia", "Juazeiro do Norte", "Maracanaú", "Sobral"],
    "DF": ["Brasília"],
    "ES": ["Vitória", "Vila Velha", "Cariacica", "Serra", "Cachoeiro de Itapemirim"],
    "MT": ["Cuiabá", "Várzea Grande", "Rondonópolis", "Sinop", "Tangará da Serra"],
    "MS": ["Campo Grande", "Dourados", "Três Lagoas", "Corumbá", "Ponta Porã"],
    "PB": ["João Pessoa", "Campina Grande", "Santa Rita", "Patos", "Bayeux"],
    "AL": ["Maceió", "Arapiraca", "Rio Largo", "Palmeira dos Índios", "União dos Palmares"],
    "RN": ["Natal", "Mossoró", "Parnamirim", "São Gonçalo do Amarante", "Macaíba"],
    "PI": ["Teresina", "Parnaíba", "Picos", "Piripiri", "Floriano"],
    "MA": ["São Luís", "Imperatriz", "Caxias", "Timon", "Codó"],
    "SE": ["Aracaju", "Nossa Senhora do Socorro", "Lagarto", "Itabaiana", "São Cristóvão"],
    "TO": ["Palmas", "Araguaína", "Gurupi", "Porto Nacional", "Paraíso do Tocantins"],
    "AC": ["Rio Branco", "Cruzeiro do Sul", "Sena Madureira", "Tarauacá", "Feijó"],
    "AM": ["Manaus", "Parintins", "Itacoatiara", "Manacapuru", "Coari"],
    "RO": ["Porto Velho", "Ji-Paraná", "Ariquemes", "Vilhena", "Cacoal"],
    "RR": ["Boa Vista", "Rorainópolis", "Caracaraí", "Alto Alegre", "Mucajaí"],
    "AP": ["Macapá", "Santana", "Laranjal do Jari", "Oiapoque", "Mazagão"],
    "PA": ["Belém", "Ananindeua", "Marituba", "Paragominas", "Castanhal"],
}

# Generated colours and door counts with their weights.
COLOR_WEIGHTS = {
    "Branco": 0.25, "Prata": 0.20, "Preto": 0.15, "Cinza": 0.10, "Vermelho": 0.08,
    "Azul": 0.07, "Bege": 0.05, "Verde": 0.04, "Dourado": 0.03, "Marrom": 0.03,
}
DOOR_WEIGHTS = {2: 0.05, 4: 0.85, 5: 0.10}

# Mileage bands (age up to, low, high, multiplied by age).
MILEAGE_BANDS = [
    (0, 0, 5000, False),
    (1, 5000, 20000, False),
    (3, 12000, 20000, True),
    (5, 13000, 18000, True),
    (10, 10000, 16000, True),
    (None, 8000, 14000, True),
]
# Mileage factor by price (price above, low, high) and its noise.
MILEAGE_PRICE_FACTORS = [(100000, 0.7, 0.9), (50000, 0.85, 1.0)]
MILEAGE_NOISE = (0.9, 1.1)

# Condition odds (age up to, km per year below, word -> weight).
CONDITION_BANDS = [
    (2, 15000, {"Ótimo": 0.3, "Excelente": 0.7}),
    (5, 18000, {"Bom": 0.4, "Ótimo": 0.6}),
    (10, 20000, {"Bom": 0.5, "Ótimo": 0.3, "Regular": 0.2}),
    (None, None, {"Bom": 0.6, "Regular": 0.4}),
]

# Price edges of the stratified split.
SPLIT_PRICE_EDGES = [0, 20000, 40000, 60000, 80000, 100000, 150000, 200000, 300000, 500000, None]

# Right-closed segment edges and labels (None = unbounded).
PRICE_SEGMENT_EDGES = [0, 30000, 50000, 70000, 100000, 150000, 200000, None]
PRICE_SEGMENT_LABELS = ["<30k", "30-50k", "50-70k", "70-100k", "100-150k", "150-200k", ">200k"]
AGE_SEGMENT_EDGES = [0, 2, 5, 10, 15, None]
AGE_SEGMENT_LABELS = ["0-2", "3-5", "6-10", "11-15", ">15"]
SEGMENT_FALLBACK_YEAR = 2024

# Left-closed price categories (below limit -> label).
PRICE_CATEGORIES = [
    (20000, "Very Low (< R$ 20k)"),
    (50000, "Low (R$ 20k - 50k)"),
    (100000, "Medium (R$ 50k - 100k)"),
    (200000, "High (R$ 100k - 200k)"),
    (500000, "Very High (R$ 200k - 500k)"),
    (None, "Luxury (> R$ 500k)"),
]

# Right-closed ranges of the box-plot reports.
AGE_RANGE_EDGES = [0, 5, 10, 15, 20, 25, 50]
AGE_RANGE_LABELS = ["0-5", "6-10", "11-15", "16-20", "21-25", "26+"]
KM_RANGE_EDGES = [0, 50000, 100000, 150000, 200000, 300000, 600000]
KM_RANGE_LABELS = ["0-50k", "50-100k", "100-150k", "150-200k", "200-300k", "300k+"]

# Labels of the five equal-width age bins.
AGE_BIN_LABELS = ["Very_New", "New", "Medium", "Old", "Very_Old"]

# City size by number of rows (more than limit -> label).
CITY_SIZES = [(1000, "Large"), (100, "Medium"), (None, "Small")]

# Quality score by number of issue categories (up to -> label).
QUALITY_SCORES = [(0, "EXCELLENT"), (3, "GOOD"), (6, "FAIR"), (None, "POOR")]

# Raw column -> canonical column.
RAW_RENAMES = {
    "brand": "brand",
    "model": "model",
    "year_model": "year",
    "avg_price_brl": "price",
    "fuel": "fuel_type",
    "gear": "transmission",
    "engine_size": "engine_size",
    "year_of_reference": "year_of_reference",
    "month_of_reference": "month_of_reference",
}

# Ranges a scoring request must meet, and its defaults.
REQUEST_RANGES = {
    "year": (1985, 2023),
    "km": (0, 500000),
    "engine_size": (0.7, 7.0),
    "doors": (2, 5),
    "age_years": (0, 40),
    "year_of_reference": (2020, 2024),
}
REQUEST_DEFAULTS = {"year_of_reference": 2024, "month_of_reference": "2024-01"}
