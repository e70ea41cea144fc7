"""Explicit schemas of inputs and canonical tables, and the options by which readings of the model differ."""

from __future__ import annotations

# Inputs
SYNAPSE_JSON = "type STRING, location ARRAY<DOUBLE>, confidence DOUBLE, rois ARRAY<STRING>"
EDGE_JSON = "pre ARRAY<BIGINT>, post ARRAY<BIGINT>"
BODY_JSON = (
    "id DECIMAL(38,9), status STRING, name STRING, type STRING, instance STRING, primaryNeurite STRING, majorInput STRING, majorOutput STRING, clonalUnit STRING, "
    "neurotransmitter STRING, property STRING, size BIGINT, rois ARRAY<STRING>, soma STRUCT<location: ARRAY<BIGINT>, radius: DOUBLE>, synapseSet ARRAY<ARRAY<BIGINT>>"
)
META_JSON = "neuroglancerInfo STRING, uuid STRING, dvidServer STRING, meshHost STRING, statusDefinitions STRING, info STRING"
RELS_JSON = "Pos ARRAY<BIGINT>, Kind STRING, Rels ARRAY<STRUCT<Rel: STRING, To: ARRAY<BIGINT>>>"
SYNAPSE_CSV = "x BIGINT, y BIGINT, z BIGINT, kind STRING, conf DOUBLE"
MAPPED_CSV = "syn_id BIGINT, x BIGINT, y BIGINT, z BIGINT, type STRING, confidence DOUBLE, super_roi STRING, sub1_roi STRING, sub2_roi STRING, sub3_roi STRING, body_id BIGINT"
EDIT = (
    "seq BIGINT, ts TIMESTAMP, mutation_key STRING, kind STRING, body_id BIGINT, bodies ARRAY<BIGINT>, syn_id BIGINT, post_id BIGINT, x BIGINT, y BIGINT, z BIGINT, type STRING, "
    "confidence DOUBLE, roi STRING, rois ARRAY<STRING>, synapses ARRAY<BIGINT>, props MAP<STRING,STRING>, skeleton ARRAY<STRUCT<row_no: INT, type: INT, x: BIGINT, y: BIGINT, z: BIGINT, radius: DOUBLE, parent_row: INT>>"
)
_PLACES = "ARRAY<STRUCT<location: ARRAY<DOUBLE>, type: STRING>>"
#: A document or the arguments of a procedure; of an action, which has names that differ in case alone.
EDIT_DOCUMENT = (
    "seq BIGINT, ts TIMESTAMP, procedure STRING, id BIGINT, bodyId BIGINT, size BIGINT, mutationUUID STRING, mutationID BIGINT, status STRING, name STRING, type STRING, instance STRING, "
    "primaryNeurite STRING, majorInput STRING, majorOutput STRING, clonalUnit STRING, neurotransmitter STRING, property STRING, soma STRUCT<location: ARRAY<BIGINT>, radius: DOUBLE>, "
    f"currentSynapses {_PLACES}, location ARRAY<DOUBLE>, confidence DOUBLE, rois ARRAY<STRING>, roiName STRING, x DOUBLE, y DOUBLE, z DOUBLE, preX DOUBLE, preY DOUBLE, preZ DOUBLE, postX DOUBLE, postY DOUBLE, postZ DOUBLE"
)
ACTION_DOCUMENT = f"Action STRING, DVIDuuid STRING, MutationID BIGINT, TargetBodyID BIGINT, BodiesMerged ARRAY<BIGINT>, OrigBodyId BIGINT, NewBodyId BIGINT, NewBodySynapses {_PLACES}"

# Canonical tables
SYNAPSE = "syn_id BIGINT, x BIGINT, y BIGINT, z BIGINT, type STRING, confidence DOUBLE, rois ARRAY<STRING>"
SYN_EDGE = "pre_id BIGINT, post_id BIGINT"
MEMBERSHIP = "body_id BIGINT, syn_id BIGINT"
SKEL_NODE = "body_id BIGINT, row_no INT, type INT, x BIGINT, y BIGINT, z BIGINT, radius DOUBLE, parent_row INT"
ROI_COUNTS = "MAP<STRING,STRUCT<pre: BIGINT, post: BIGINT>>"
ROI_COUNTS_HP = "MAP<STRING,STRUCT<pre: BIGINT, post: BIGINT, preHP: BIGINT, postHP: BIGINT>>"

#: Attributes by which a body is a neuron whatever its counts.
EVIDENCE = ("status", "name", "instance", "primary_neurite", "major_input", "major_output", "clonal_unit", "neurotransmitter", "property", "soma")
#: Regions that loads leave out.
IGNORED_ROIS = ("seven_column_roi", "kc_alpha_roi")
#: Names that no dataset may have, as they are labels.
RESERVED = ("Neuron", "Segment", "Synapse", "PreSyn", "PostSyn", "SynapseSet", "ConnectionSet", "Skeleton", "SkelNode", "Meta", "DataModel")
#: Ids of synapses that get one in file order start here.
FIRST_SYNAPSE_ID = 99_000_000_000

WEIGHT_MODES = ("distinct_post", "edges")
HP_RULES = ("post_gt", "both_gt", "post_ge")
