"""Dataset names, their feature and label columns, and the image classes."""

from __future__ import annotations

from dataclasses import dataclass, field

# Column names, labels and class order of the public datasets.
IMAGE_CLASSES = ["Cyclone", "Earthquake", "Flood", "Wildfire"]
IMAGE_EXTENSIONS = ["png", "jpg", "jpeg", "gif", "bmp"]
UNKNOWN_LABEL = "Unknown"
CHINA_FEATURES = ["震源深度(Km)", "mL", "mb", "mB"]
CHINA_LABEL = "Ms7"
GLOBAL_FEATURES = ["震源深度(Km)", "Ms7", "mL", "mb", "mB"]
GLOBAL_LABEL = "Ms"
STRONG_MOTION_FEATURES = [
    "震源深度", "震中距", "仪器烈度", "总峰值加速度PGA", "总峰值速度PGV", "参考Vs30",
    "东西分量PGA", "南北分量PGA", "竖向分量PGA", "东西分量PGV", "南北分量PGV", "竖向分量PGV",
]
STRONG_MOTION_LABEL = "震级"
# End of fixed values.


@dataclass(frozen=True)
class DatasetSpec:
    """What a table holds and how it is trained on.

    ``features`` never contain the label: a row-normalised vector that includes
    it would leak it through the norm. ``with_label`` gives the leaking variant.
    """

    name: str
    features: list
    label: str | None
    pca_k: int | None = None
    folds: int = 3
    aliases: tuple = field(default_factory=tuple)
    description: str = ""

    @property
    def required(self) -> list:
        return list(self.features) + ([self.label] if self.label else [])

    def with_label(self) -> "DatasetSpec":
        return DatasetSpec(self.name, list(self.features) + [self.label], self.label, self.pca_k,
                           self.folds, self.aliases, self.description)


_REGISTRY: dict = {}


def register(spec: DatasetSpec) -> DatasetSpec:
    for name in (spec.name, *spec.aliases):
        _REGISTRY[name] = spec
    return spec


def dataset(name: str) -> DatasetSpec:
    if name not in _REGISTRY:
        raise ValueError(f"unknown dataset {name!r}; choose one of: {', '.join(sorted(_REGISTRY))}")
    return _REGISTRY[name]


def dataset_names() -> list:
    return sorted({spec.name for spec in _REGISTRY.values()})


# Names and aliases of the public datasets.
register(DatasetSpec("CEN_Center_Earthquake_Catalog", CHINA_FEATURES, CHINA_LABEL, pca_k=4, folds=3,
                     aliases=("中国地震台网地震目录数据集训练",),
                     description="Chinese network catalogue"))
register(DatasetSpec("GSN_Earthquake_Catalog", GLOBAL_FEATURES, GLOBAL_LABEL, pca_k=5, folds=3,
                     aliases=("全球地震台网地震目录数据集训练",),
                     description="global network catalogue"))
register(DatasetSpec("Strong_Motion_Parameters_Dataset", STRONG_MOTION_FEATURES, STRONG_MOTION_LABEL,
                     pca_k=9, folds=5, aliases=("强震动参数数据集训练",),
                     description="strong-motion parameters"))
register(DatasetSpec("Earthquake_disaster_data_list", [], None, description="losses; cleaned only"))
# End of fixed values.
