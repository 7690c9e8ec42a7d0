"""Model documents the queries over the given tables score with."""

from __future__ import annotations

import json

_HEAD = '<?xml version="1.0" encoding="UTF-8"?><PMML xmlns="http://www.dmg.org/PMML-4_3" version="4.3">'


def _schema(fields: list[str], classes: list[str] | None = None) -> tuple[str, str]:
    values = "".join(f'<Value value="{c}"/>' for c in classes or [])
    target = (
        f'<DataField name="grade" optype="categorical" dataType="string">{values}</DataField>'
        if classes
        else '<DataField name="grade" optype="continuous" dataType="double"/>'
    )
    inputs = "".join(f'<DataField name="{f}" optype="continuous" dataType="double"/>' for f in fields)
    mining = '<MiningField name="grade" usageType="target"/>' + "".join(f'<MiningField name="{f}"/>' for f in fields)
    return f"<DataDictionary>{target}{inputs}</DataDictionary>", f"<MiningSchema>{mining}</MiningSchema>"


def leaf(score: str, **counts: int) -> dict:
    return {"score": score, "counts": {k.lstrip("c"): v for k, v in counts.items()}}


def split(field: str, operator: str, value: float, first: dict, second: dict) -> dict:
    return {"field": field, "operator": operator, "value": value, "first": first, "second": second}


_OPPOSITE = {
    "lessOrEqual": "greaterThan",
    "greaterThan": "lessOrEqual",
    "lessThan": "greaterOrEqual",
    "greaterOrEqual": "lessThan",
}


def _node(node: dict, test: str) -> str:
    counts = "".join(
        f'<ScoreDistribution value="{c}" recordCount="{n}.0"/>' for c, n in node.get("counts", {}).items()
    )
    if "field" not in node:
        return f'<Node score="{node["score"]}">{test}{counts}</Node>'
    tests = [
        f'<SimplePredicate field="{node["field"]}" operator="{op}" value="{node["value"]}"/>'
        for op in (node["operator"], _OPPOSITE[node["operator"]])
    ]
    return f'<Node>{test}{_node(node["first"], tests[0])}{_node(node["second"], tests[1])}</Node>'


def tree_document(root: dict, fields: list[str], classes: list[str] | None = None) -> str:
    dictionary, mining = _schema(fields, classes)
    function = "classification" if classes else "regression"
    return (
        f'{_HEAD}{dictionary}<TreeModel functionName="{function}" splitCharacteristic="binarySplit">{mining}'
        f'{_node(root, "<True/>")}</TreeModel></PMML>'
    )


def forest_document(roots: list[dict], fields: list[str], classes: list[str]) -> str:
    dictionary, mining = _schema(fields, classes)
    segments = "".join(
        f'<Segment id="{i}"><True/><TreeModel functionName="classification" splitCharacteristic="binarySplit">{mining}'
        f'{_node(root, "<True/>")}</TreeModel></Segment>'
        for i, root in enumerate(roots, start=1)
    )
    return (
        f'{_HEAD}{dictionary}<MiningModel functionName="classification">{mining}'
        f'<Segmentation multipleModelMethod="average">{segments}</Segmentation></MiningModel></PMML>'
    )


def network_document(layers: list[tuple[list[list[float]], list[float]]], fields: list[str], classes: list[str]) -> str:
    """Logistic hidden layers and a softmax over the last one."""
    dictionary, mining = _schema(fields, classes)
    inputs = "".join(
        f'<NeuralInput id="0/{i}"><DerivedField optype="continuous" dataType="double"><FieldRef field="{f}"/>'
        "</DerivedField></NeuralInput>"
        for i, f in enumerate(fields, start=1)
    )
    body = ""
    for depth, (weights, biases) in enumerate(layers, start=1):
        last = depth == len(layers)
        neurons = "".join(
            f'<Neuron id="{depth}/{j}" bias="{bias}">'
            + "".join(f'<Con from="{depth - 1}/{i}" weight="{w}"/>' for i, w in enumerate(row, start=1))
            + "</Neuron>"
            for j, (row, bias) in enumerate(zip(weights, biases), start=1)
        )
        extra = ' activationFunction="identity" normalizationMethod="softmax"' if last else ""
        body += f"<NeuralLayer{extra}>{neurons}</NeuralLayer>"
    outputs = "".join(
        f'<NeuralOutput outputNeuron="{len(layers)}/{j}"><DerivedField optype="categorical" dataType="string">'
        f'<NormDiscrete field="grade" value="{c}"/></DerivedField></NeuralOutput>'
        for j, c in enumerate(classes, start=1)
    )
    return (
        f'{_HEAD}{dictionary}<NeuralNetwork functionName="classification" activationFunction="logistic">{mining}'
        f"<NeuralInputs>{inputs}</NeuralInputs>{body}<NeuralOutputs>{outputs}</NeuralOutputs></NeuralNetwork></PMML>"
    )


def layers_document(layers: list[tuple[list[list[float]], list[float], str]]) -> str:
    return json.dumps({"layers": [{"w": w, "b": b, "act": act} for w, b, act in layers]})


LINEAR = (
    f"{_HEAD}{_schema(['quantity', 'discount', 'tax', 'colour'])[0]}"
    f'<RegressionModel functionName="regression">{_schema(["quantity", "discount", "tax", "colour"])[1]}'
    '<RegressionTable intercept="3.25"><NumericPredictor name="quantity" coefficient="0.5"/>'
    '<NumericPredictor name="discount" coefficient="-12.5"/><NumericPredictor name="tax" coefficient="8"/>'
    '<NumericPredictor name="colour" coefficient="4"/></RegressionTable></RegressionModel></PMML>'
)

GLM_LOG = (
    f"{_HEAD}{_schema(['quantity', 'extended price', 'discount'])[0]}"
    '<GeneralRegressionModel modelType="generalizedLinear" functionName="regression" linkFunction="log" '
    f'distribution="gamma">{_schema(["quantity", "extended price", "discount"])[1]}'
    '<ParameterList><Parameter name="p0" label="(intercept)"/><Parameter name="p1"/><Parameter name="p2"/>'
    '<Parameter name="p3"/></ParameterList><CovariateList><Predictor name="quantity"/>'
    '<Predictor name="extended price"/><Predictor name="discount"/></CovariateList>'
    '<PPMatrix><PPCell value="2" predictorName="quantity" parameterName="p1"/>'
    '<PPCell value="0.5" predictorName="extended price" parameterName="p2"/>'
    '<PPCell value="1" predictorName="discount" parameterName="p3"/></PPMatrix>'
    '<ParamMatrix><PCell parameterName="p0" beta="0.5"/><PCell parameterName="p1" beta="0.0004"/>'
    '<PCell parameterName="p2" beta="0.003"/><PCell parameterName="p3" beta="-1.5"/></ParamMatrix>'
    "</GeneralRegressionModel></PMML>"
)

TREE_REGRESSION = tree_document(
    split(
        "extended price",
        "lessOrEqual",
        30000.0,
        split("quantity", "lessOrEqual", 20.0, leaf("1.5"), leaf("2.25")),
        split(
            "discount", "lessOrEqual", 0.05, leaf("3.75"), split("tax", "lessThan", 0.04, leaf("4.5"), leaf("5.125"))
        ),
    ),
    ["extended price", "quantity", "discount", "tax"],
)

CLASSES = ["5", "6", "7"]

# The first leaf has two classes of the same count: the label of the node decides.
TREE_CLASSES = tree_document(
    split(
        "quantity",
        "lessOrEqual",
        25.0,
        split("extended price", "lessOrEqual", 20000.0, leaf("6", c5=2, c6=2), leaf("5", c5=7, c6=2, c7=1)),
        split("tax", "greaterThan", 0.03, leaf("7", c6=1, c7=3), leaf("6", c5=1, c6=5)),
    ),
    ["quantity", "extended price", "tax"],
    CLASSES,
)

PART_NAMES = ["size", "price", "sold", "lines"]

FOREST = forest_document(
    [
        split("size", "lessOrEqual", 20.0, leaf("5", c5=6, c6=2), leaf("7", c5=1, c6=1, c7=6)),
        split(
            "price",
            "lessOrEqual",
            950.0,
            split("sold", "lessOrEqual", 700.0, leaf("5", c5=3, c6=1), leaf("6", c5=1, c6=3)),
            leaf("7", c6=2, c7=2),
        ),
        split("lines", "lessThan", 30.0, leaf("6", c5=2, c6=5, c7=1), leaf("5", c5=4, c7=1)),
    ],
    PART_NAMES,
    CLASSES,
)

WIDTH = 64
VECTOR_NAMES = [f"e{i}" for i in range(WIDTH)]


def weight(j: int, i: int) -> float:
    """The rule behind the network weights."""
    return ((i * 7 + j * 3) % 11 - 5) / 10


def bias(j: int) -> float:
    return (j % 5 - 2) / 10


def network(width: int, hidden: int, outputs: int) -> list[tuple[list[list[float]], list[float]]]:
    return [
        ([[weight(j, i) for i in range(width)] for j in range(hidden)], [bias(j) for j in range(hidden)]),
        ([[weight(j + 1, i) for i in range(hidden)] for j in range(outputs)], [bias(j + 1) for j in range(outputs)]),
    ]


NETWORK = network_document(network(WIDTH, 4, 3), VECTOR_NAMES, CLASSES)
DENSE = layers_document([([[weight(j, i) for i in range(WIDTH)] for j in range(10)], [bias(j) for j in range(10)], "sigmoid")])
