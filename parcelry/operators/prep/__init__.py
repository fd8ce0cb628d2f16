from parcelry.operators.prep.base import PreprocessingPipeline, PreprocessingStrategy
from parcelry.operators.prep.encoders import LabelEncoding, OneHotEncoding, TargetEncoding
from parcelry.operators.prep.impute import MICEImputation
from parcelry.operators.prep.outliers import IQRMethod, ZScoreMethod
from parcelry.operators.prep.power import BoxCoxTransformer, YeoJohnsonTransformer
from parcelry.operators.prep.scalers import MinMaxScaling, Normalizing, RobustScaling, StandardScaling

__all__ = [
    "BoxCoxTransformer",
    "IQRMethod",
    "LabelEncoding",
    "MICEImputation",
    "MinMaxScaling",
    "Normalizing",
    "OneHotEncoding",
    "PreprocessingPipeline",
    "PreprocessingStrategy",
    "RobustScaling",
    "StandardScaling",
    "TargetEncoding",
    "YeoJohnsonTransformer",
    "ZScoreMethod",
]
