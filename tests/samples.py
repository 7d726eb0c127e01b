"""Pairs that the golden tests share."""

# The example pairs.
SAMPLE_PAIRS = (
    (
        "La inteligencia artificial es una rama de la informática que busca crear sistemas capaces de realizar tareas que normalmente requieren inteligencia humana. Estos sistemas pueden aprender de la experiencia, ajustarse a nuevas entradas y realizar tareas similares a las humanas. El aprendizaje automático y el aprendizaje profundo son subcampos importantes de la IA.",
        "La IA crea sistemas que realizan tareas que requieren inteligencia humana mediante aprendizaje automático.",
    ),
    (
        "El cambio climático es uno de los mayores desafíos que enfrenta la humanidad en el siglo XXI. Las temperaturas globales están aumentando debido a las emisiones de gases de efecto invernadero. Esto está causando el derretimiento de los glaciares, el aumento del nivel del mar y eventos climáticos extremos más frecuentes.",
        "El cambio climático causa aumento de temperaturas, derretimiento de glaciares y eventos climáticos extremos.",
    ),
    (
        "Python es un lenguaje de programación de alto nivel, interpretado y de propósito general. Su filosofía de diseño enfatiza la legibilidad del código con el uso de una sintaxis clara. Python soporta múltiples paradigmas de programación, incluyendo programación orientada a objetos, imperativa y funcional.",
        "Python es un lenguaje de programación de alto nivel con sintaxis clara y múltiples paradigmas.",
    ),
    (
        "Las redes neuronales son modelos computacionales inspirados en el cerebro humano. Están compuestas por capas de nodos interconectados que procesan información. Cada conexión tiene un peso que se ajusta durante el entrenamiento. Las redes neuronales profundas han revolucionado campos como la visión por computadora y el procesamiento del lenguaje natural.",
        "Las redes neuronales son modelos inspirados en el cerebro que procesan información mediante capas interconectadas.",
    ),
    (
        "El aprendizaje profundo es una técnica de machine learning que utiliza redes neuronales con múltiples capas. Estas redes pueden aprender representaciones jerárquicas de los datos. El deep learning ha logrado avances impresionantes en reconocimiento de imágenes, procesamiento de voz y traducción automática.",
        "El deep learning usa redes neuronales profundas para aprender representaciones jerárquicas de datos.",
    ),
)


def sample_pairs(spark):
    rows = [(i, text, summary) for i, (text, summary) in enumerate(SAMPLE_PAIRS)]
    return spark.createDataFrame(rows, "doc_id long, texto string, resumen string")
