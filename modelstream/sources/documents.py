"""Model documents to parameter columns.

XML model documents (regression, general regression, tree, tree ensemble, neural network) are read by the standard library's
parser inside an Arrow function over the small model table; trees may be of any depth, and every document is walked once.
Whatever the parameters cannot hold exactly (an element or attribute that changes the answer and is not listed here,
interaction terms, other predicates or ensemble rules, links over layers) yields null, never a guess, and the
registry treats it as a model that failed to build. Dense layers in JSON are read with Spark's own functions.
"""

from __future__ import annotations

from typing import Any
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from modelstream.config import ship_package
from modelstream.schemas import LAYER, PARAM_FIELDS, PARAMS, params_struct

Element = ElementTree.Element
Params = dict[str, Any]

# Elements without influence on a score, and attributes of any model without one.
SILENT = {"Extension", "Output", "ModelStats", "ModelExplanation", "ModelVerification"}
NAMES = {"modelName", "algorithmName", "functionName", "isScorable"}


class Unsupported(ValueError):
    """The document asks for something that the parameters cannot hold."""


def _need(test: bool, what: str) -> None:
    if not test:
        raise Unsupported(what)


def _tag(e: Element) -> str:
    return e.tag.rpartition("}")[2]


def _number(text: str | None, default: float | None = None) -> float:
    if text is None and default is not None:
        return default
    _need(text is not None and "_" not in text, "a number is missing")
    return float(text)


def _parts(e: Element, *known: str, attributes: set[str] = frozenset()) -> dict[str, list[Element]]:
    """The children by name. Attributes and children outside those that are named are not supported."""
    _need(set(e.attrib) <= attributes, f"{_tag(e)} with {sorted(e.attrib)}")
    out: dict[str, list[Element]] = {name: [] for name in known}
    for child in e:
        name = _tag(child)
        if name not in SILENT:
            _need(name in out, f"{name} in {_tag(e)}")
            out[name].append(child)
    return out


def _one(found: list[Element], what: str) -> Element:
    _need(len(found) == 1, f"one {what}")
    return found[0]


# --- what all models share ------------------------------------------------------------------------------------------


class Fields:
    """The inputs by position and the classes of the declared fields. An input without a declaration takes any number."""

    def __init__(self, dictionaries: list[Element], names: list[str]) -> None:
        self.positions = {name: i for i, name in enumerate(names)}
        self.width = len(names)
        self.declared: dict[str, Element] = {}
        _need(len(dictionaries) < 2, "one dictionary")
        for dictionary in dictionaries:
            for field in _parts(dictionary, "DataField", attributes={"numberOfFields"})["DataField"]:
                self.declared[field.get("name")] = field

    def input(self, name: str | None) -> int:
        """The position of a continuous input that takes any number; that behind the last one, read as 0.0, if unknown."""
        _need(name is not None, "an input")
        field = self.declared.get(name)
        if field is not None:
            _need(field.get("optype") == "continuous" and field.get("dataType") in ("double", "integer"), f"input {name}")
            _parts(field, attributes=set(field.attrib))
        return self.positions.get(name, self.width)

    def labels(self, schemas: list[Element]) -> list[str]:
        """The classes of the target, in the order the document declares them."""
        target = [m.get("name") for schema in schemas for m in schema if m.get("usageType") in ("target", "predicted")]
        _need(len(target) == 1 and target[0] in self.declared, "one target")
        values = [v for v in self.declared[target[0]] if _tag(v) == "Value"]
        _need(all(v.get("property", "valid") == "valid" for v in values), "values of the target")
        return [v.get("value") for v in values]


def _model(e: Element, functions: tuple[str, ...], *known: str, attributes: set[str] = frozenset()) -> dict[str, list[Element]]:
    """The parts of a model whose schema and targets change no value."""
    _need(e.get("functionName") in functions and e.get("isScorable", "true") == "true", "the function")
    parts = _parts(e, "MiningSchema", "Targets", "LocalTransformations", *known, attributes=NAMES | attributes)
    _need(len(parts["MiningSchema"]) < 2, "one schema")
    for field in (f for schema in parts["MiningSchema"] for f in _parts(schema, "MiningField")["MiningField"]):
        _parts(
            field,
            attributes={"name", "usageType", "optype", "importance", "outliers", "lowValue", "highValue", "missingValueTreatment", "invalidValueTreatment"},
        )
        _need(field.get("outliers", "asIs") == "asIs" and field.get("missingValueTreatment") != "returnInvalid", "a treatment")
    for target in (t for targets in parts["Targets"] for t in targets if _tag(t) not in SILENT):
        _parts(target, attributes={"field", "optype", "rescaleConstant", "rescaleFactor"})
        _need(_number(target.get("rescaleConstant"), 0.0) == 0 and _number(target.get("rescaleFactor"), 1.0) == 1, "a rescaled target")
    _need(not any(len(t) for t in parts["LocalTransformations"]), "derived fields")
    return parts


def _terms(fields: Fields, terms: list[tuple[str, float, float]], intercept: float) -> tuple[float, list[float], list[float]]:
    """Intercept, coefficients and exponents by position. An unknown input is 0.0, and so is each positive power of it."""
    coefs, exponents = [0.0] * fields.width, [1.0] * fields.width
    _need(len({name for name, _, _ in terms}) == len(terms), "terms of one input")
    for name, coefficient, exponent in terms:
        at = fields.input(name)
        if at < fields.width:
            coefs[at], exponents[at] = coefficient, exponent
        else:
            _need(exponent >= 0, "a negative power of 0")
            intercept += coefficient if exponent == 0 else 0.0
    return intercept, coefs, exponents


# --- regression -----------------------------------------------------------------------------------------------------


def _regression(e: Element, fields: Fields) -> Params:
    parts = _model(e, ("regression",), "RegressionTable", attributes={"normalizationMethod", "modelType", "targetFieldName"})
    table = _one(parts["RegressionTable"], "table")
    links = {"none": "identity", "exp": "log", "logit": "logit"}
    method = e.get("normalizationMethod", "none")
    _need(method in links, method)
    terms = []
    for t in _parts(table, "NumericPredictor", attributes={"intercept"})["NumericPredictor"]:
        _parts(t, attributes={"name", "exponent", "coefficient"})
        terms.append((t.get("name"), _number(t.get("coefficient")), _number(t.get("exponent"), 1.0)))
    intercept, coefs, exponents = _terms(fields, terms, _number(table.get("intercept")))
    if links[method] == "identity" and all(x == 1 for x in exponents):
        return {"form": "linear", "intercept": intercept, "coefs": coefs, "link": "identity"}
    return {"form": "glm", "intercept": intercept, "coefs": coefs, "exponents": exponents, "link": links[method]}


def _general_regression(e: Element, fields: Fields) -> Params:
    parts = _model(
        e, ("regression",), "ParameterList", "FactorList", "CovariateList", "PPMatrix", "ParamMatrix", "PCovMatrix",
        attributes={"modelType", "linkFunction", "distribution", "distParameter", "targetVariableName", "modelDF"},
    )
    kind, link = e.get("modelType"), e.get("linkFunction", "identity")
    _need(kind == "generalizedLinear" or kind in ("regression", "generalLinear") and link == "identity", f"model type {kind}")
    _need(link in ("identity", "log", "logit", "inverse"), link)
    _need(not any(len(f) for f in parts["FactorList"]), "factors")
    betas: dict[str, float] = {}
    for cell in _parts(_one(parts["ParamMatrix"], "parameters"), "PCell")["PCell"]:
        _parts(cell, attributes={"parameterName", "beta", "df"})
        _need(cell.get("parameterName") not in betas, "a parameter twice")
        betas[cell.get("parameterName")] = _number(cell.get("beta"))
    _need(bool(betas), "no parameters")
    terms, used = [], set()
    for matrix in parts["PPMatrix"]:
        for cell in _parts(matrix, "PPCell")["PPCell"]:
            _parts(cell, attributes={"value", "predictorName", "parameterName"})
            _need(cell.get("parameterName") not in used, "an interaction")
            used.add(cell.get("parameterName"))
            terms.append((cell.get("predictorName"), betas.get(cell.get("parameterName"), 0.0), _number(cell.get("value"))))
    intercept, coefs, exponents = _terms(fields, terms, sum(b for name, b in betas.items() if name not in used))
    return {"form": "glm", "intercept": intercept, "coefs": coefs, "exponents": exponents, "link": link}


# --- trees ----------------------------------------------------------------------------------------------------------


_OPPOSITE = {
    "lessOrEqual": "greaterThan",
    "greaterThan": "lessOrEqual",
    "lessThan": "greaterOrEqual",
    "greaterOrEqual": "lessThan",
}


def _test(node: dict[str, list[Element]]) -> tuple[str, str, float] | None:
    """Field, operator and value of a node's predicate; None for the one that is always true."""
    simple = node["SimplePredicate"]
    _need(len(simple) + len(node["True"]) == 1, "one predicate")
    if not simple:
        return None
    _parts(simple[0], attributes={"field", "operator", "value"})
    _need(simple[0].get("operator") in _OPPOSITE, "the operator")
    return simple[0].get("field"), simple[0].get("operator"), _number(simple[0].get("value"))


def _shares(counts: list[Element], labels: list[str]) -> list[float] | None:
    """The share of each class."""
    found = dict.fromkeys(labels, 0.0)
    for c in counts:
        _parts(c, attributes={"value", "recordCount", "confidence"})
        _need(c.get("value") in found, "an undeclared class")
        found[c.get("value")] += _number(c.get("recordCount"))
    total = sum(found.values())
    return [n / total for n in found.values()] if total > 0 else None


def _nodes(root: Element, fields: Fields, labels: list[str]) -> tuple[list[Params], int]:
    """The nodes of a tree, the root first, with positions for children; and its depth. Inner nodes have two children
    of which one takes what the other does not."""
    out: list[Params] = []
    deepest = 0
    # Each entry: the element with its parts, its level, and where its position is to be written.
    waiting: list[tuple[Element, dict, int, Params | None, str]] = []

    def read(e: Element) -> dict[str, list[Element]]:
        return _parts(
            e, "SimplePredicate", "True", "ScoreDistribution", "Node", attributes={"id", "score", "recordCount", "defaultChild"}
        )

    parts = read(root)
    _need(_test(parts) is None, "a test of the root")
    waiting.append((root, parts, 0, None, ""))
    while waiting:
        e, parts, level, above, side = waiting.pop()
        if above is not None:
            above[side] = len(out)
        deepest = max(deepest, level)
        score, probs = e.get("score"), _shares(parts["ScoreDistribution"], labels) if labels else None
        node: Params = {"f": -1, "thr": None, "strict": None, "l": None, "r": None, "score": score, "probs": probs}
        out.append(node)
        if not parts["Node"]:
            _need(score is not None and (not labels or probs is not None), "a leaf without a value")
            if not labels:
                _number(score)
            continue
        _need(len(parts["Node"]) == 2, "two children")
        kids = [(kid, read(kid)) for kid in parts["Node"]]
        first, second = (_test(of) for _, of in kids)
        _need(first is not None and (second is None or second == (first[0], _OPPOSITE[first[1]], first[2])), "opposite tests")
        field, operator, value = first
        node |= {"f": fields.input(field), "thr": value, "strict": operator in ("lessThan", "greaterOrEqual")}
        sides = "lr" if operator in ("lessThan", "lessOrEqual") else "rl"
        for side, (kid, of) in reversed(list(zip(sides, kids))):
            waiting.append((kid, of, level + 1, node, side))
    return out, deepest


_TREE = {"splitCharacteristic", "missingValueStrategy", "missingValuePenalty", "noTrueChildStrategy"}


def _trees(e: Element, fields: Fields) -> Params:
    functions = ("regression", "classification")
    if _tag(e) == "TreeModel":
        parts = _model(e, functions, "Node", attributes=_TREE)
        roots = [_one(parts["Node"], "root")]
    else:
        parts = _model(e, functions, "Segmentation")
        inner = _one(parts["Segmentation"], "segmentation")
        _need(inner.get("multipleModelMethod") == "average", "the ensemble rule")
        roots = []
        for segment in _parts(inner, "Segment", attributes={"multipleModelMethod"})["Segment"]:
            own = _parts(segment, "True", "TreeModel", attributes={"id", "weight"})
            _need(len(own["True"]) == 1 and _number(segment.get("weight"), 1.0) == 1, "a segment with a condition")
            tree = _one(own["TreeModel"], "tree")
            roots.append(_one(_model(tree, (e.get("functionName"),), "Node", attributes=_TREE)["Node"], "root"))
        _need(bool(roots), "no trees")
    labels = fields.labels(parts["MiningSchema"]) if e.get("functionName") == "classification" else []
    _need(bool(labels) or e.get("functionName") == "regression", "no classes")
    trees = [_nodes(root, fields, labels) for root in roots]
    return {
        "form": "tree" if _tag(e) == "TreeModel" else "forest",
        "labels": labels or None,
        "depth": max(depth for _, depth in trees),
        "trees": [nodes for nodes, _ in trees],
    }


# --- networks -------------------------------------------------------------------------------------------------------


def _network(e: Element, fields: Fields) -> Params:
    parts = _model(
        e, ("classification",), "NeuralInputs", "NeuralLayer", "NeuralOutputs",
        attributes={"activationFunction", "normalizationMethod", "numberOfLayers"},
    )
    _need(e.get("normalizationMethod", "none") == "none", "normalization of all layers")
    # Where the value of each neuron of the layer below is found; inputs nobody knows are 0.0 and have no place.
    below: dict[str, int | None] = {}
    for i in _parts(_one(parts["NeuralInputs"], "inputs"), "NeuralInput", attributes={"numberOfInputs"})["NeuralInput"]:
        derived = _one(_parts(i, "DerivedField", attributes={"id"})["DerivedField"], "field")
        ref = _one(_parts(derived, "FieldRef", attributes={"name", "optype", "dataType"})["FieldRef"], "field")
        _parts(ref, attributes={"field"})
        _need(derived.get("dataType", "double") == "double" and i.get("id") not in below, "an input")
        at = fields.input(ref.get("field"))
        _need(at == fields.width or at not in below.values(), "an input twice")
        below[i.get("id")] = at if at < fields.width else None
    width, layers = fields.width, []
    _need(bool(parts["NeuralLayer"]), "no layers")
    for layer in parts["NeuralLayer"]:
        own = _parts(layer, "Neuron", attributes={"activationFunction", "normalizationMethod", "numberOfNeurons"})["Neuron"]
        act = layer.get("activationFunction", e.get("activationFunction"))
        if layer.get("normalizationMethod", "none") == "softmax":
            _need(act == "identity", "softmax of an activation")
            act = "softmax"
        else:
            _need(layer.get("normalizationMethod", "none") == "none" and act in ("identity", "logistic", "tanh", "rectifier"), "the activation")
        weights, here = [], {}
        for neuron in own:
            row, seen = [0.0] * width, set()
            for con in _parts(neuron, "Con", attributes={"id", "bias"})["Con"]:
                _parts(con, attributes={"from", "weight"})
                source = con.get("from")
                _need(source in below and source not in seen, "a link to another layer, or twice")
                seen.add(source)
                weight = _number(con.get("weight"))
                if below[source] is not None:
                    row[below[source]] = weight
            _need(neuron.get("id") not in here, "a neuron twice")
            here[neuron.get("id")] = len(weights)
            weights.append(row)
        _need(bool(weights), "an empty layer")
        layers.append({"w": weights, "b": [_number(n.get("bias"), 0.0) for n in own], "act": act})
        below, width = here, len(weights)
    labels: dict[str, str] = {}
    for output in _parts(_one(parts["NeuralOutputs"], "outputs"), "NeuralOutput", attributes={"outputNeuron"} | {"numberOfOutputs"})["NeuralOutput"]:
        derived = _one(_parts(output, "DerivedField", attributes={"outputNeuron"})["DerivedField"], "field")
        norm = _one(_parts(derived, "NormDiscrete", attributes={"name", "optype", "dataType"})["NormDiscrete"], "class")
        _parts(norm, attributes={"field", "value"})
        _need(output.get("outputNeuron") in below and output.get("outputNeuron") not in labels, "an output")
        labels[output.get("outputNeuron")] = norm.get("value")
    _need(labels.keys() == below.keys() and None not in labels.values(), "a class for each neuron of the last layer")
    return {"form": "network", "labels": [labels[n] for n in below], "layers": layers}


# --- entry points ---------------------------------------------------------------------------------------------------


_MODELS = {
    "RegressionModel": _regression,
    "GeneralRegressionModel": _general_regression,
    "TreeModel": _trees,
    "MiningModel": _trees,
    "NeuralNetwork": _network,
}


def read_document(text: str | None, names: list[str]) -> Params | None:
    """The fields of PARAMS for one XML document; None for no document and for one that cannot be held exactly."""
    if not text:
        return None
    try:
        root = ElementTree.fromstring(text)
        _need(_tag(root) == "PMML", "the root")
        parts = _parts(root, "Header", "MiningBuildTask", "DataDictionary", "TransformationDictionary", *_MODELS, attributes=set(root.attrib))
        _need(not any(len(t) for t in parts["TransformationDictionary"]), "derived fields")
        fields = Fields(parts["DataDictionary"], names)
        model = _one([m for name in _MODELS for m in parts[name]], "model")
        found = _MODELS[_tag(model)](model, fields)
    except (ElementTree.ParseError, ValueError):
        return None
    return {name: found.get(name) for name in PARAM_FIELDS}


def parse_document(models: DataFrame, text: str, names: list[str], out: str) -> DataFrame:
    """`models` with the PARAMS value of the XML document in column `text`."""
    ship_package(models.sparkSession)
    kind = T.DataType.fromDDL(PARAMS)
    arrow, order = to_arrow_type(kind), list(names)

    @F.arrow_udf(kind)
    def parse(texts: pa.Array) -> pa.Array:
        return pa.array([read_document(t, order) for t in texts.to_pylist()], arrow)

    return models.withColumn(out, parse(F.col(text)))


def parse_layers(models: DataFrame, text: str, names: list[str], out: str) -> DataFrame:
    """`models` with the PARAMS value of a dense classifier given as JSON layers in column `text`.

    ``{"layers": [{"w": [[...], ...], "b": [...], "act": "sigmoid"}, ...]}``: one row of weights and one bias per neuron, one weight
    per neuron of the layer below or per input.
    """
    doc = f"{out}_doc"
    read = models.withColumn(doc, F.from_json(F.col(text), f"struct<layers:array<{LAYER}>>"))
    layers = F.col(doc).getField("layers")
    acts = ["identity", "logistic", "sigmoid", "tanh", "rectifier", "relu", "softmax"]

    def fits(at):
        one = F.get(layers, at)
        width = F.when(at == 0, F.lit(len(names))).otherwise(F.size(F.get(layers, at - 1).getField("b")))
        return (
            one.getField("act").isin(acts)
            & (F.size(one.getField("w")) > 0)
            & (F.size(one.getField("w")) == F.size(one.getField("b")))
            & F.forall(one.getField("b"), lambda b: b.isNotNull())
            & F.forall(one.getField("w"), lambda row: (F.size(row) == width) & F.forall(row, lambda w: w.isNotNull()))
        )

    usable = F.when(F.size(layers) > 0, F.forall(F.sequence(F.lit(0), F.greatest(F.size(layers) - 1, F.lit(0))), fits))
    return read.withColumn(
        out, F.when(usable, params_struct(form=F.lit("dense"), layers=layers)).cast(PARAMS)
    ).drop(doc)
