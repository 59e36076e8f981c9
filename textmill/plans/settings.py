"""Settings of a run, also from the keyword dictionaries that training configs use."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from textmill.operators.pack import PackSettings


@dataclass(frozen=True)
class CleanSettings:
    """Row and column preparation."""

    column_dict: Mapping[str, str | Sequence[str]] = field(
        default_factory=lambda: {"inputs": ["text"], "target": "label"}
    )
    input_template: str = "{}"
    target_template: str = "{}"
    remove_html: bool = True
    pad_punctuation: bool = False
    drop_tables: bool = True
    drop_na: bool = True
    add_constants: Mapping[str, object] = field(default_factory=dict)
    keep_columns: Sequence[str] | None = None


@dataclass(frozen=True)
class SplitSettings:
    """Split sizing and sampling."""

    dev_size: int | float | None = None
    dev_from_train: bool = False
    tiny: bool = False
    tiny_size: int = 1024
    shots: int | None = None
    overfit: bool = False
    predict_size: int | None = None


@dataclass(frozen=True)
class PrepareSettings:
    """Everything between raw splits and packed rows.

    ``read_options`` go to the reader: ``schema``, ``multi_line``, ``infer_schema``, ``missing``. A
    ``row_id`` of your own spares files the numbering of their rows.
    """

    raw_data: object = None
    read_options: Mapping[str, object] = field(default_factory=dict)
    splits: Sequence[str] | None = None
    predict_split: str | None = None
    id2label: Mapping[int, str] | Sequence[str] | None = None
    deduplicate_columns: Sequence[str] = ()
    clean: CleanSettings = field(default_factory=CleanSettings)
    filter_long_sequences: bool = False
    input_limit: int = 512
    target_limit: int = 30
    split: SplitSettings = field(default_factory=SplitSettings)
    pack: PackSettings = field(default_factory=PackSettings)
    predict_prefix: str | None = None
    batch_size: int = 8
    strategy: str = ""
    seed: int = 42
    row_id: str = "_row_id"

    @classmethod
    def from_kwargs(
        cls,
        *,
        seed: int = 42,
        row_id: str = "_row_id",
        read_options: Mapping[str, object] | None = None,
        **kwargs,
    ) -> PrepareSettings:
        """Settings from a data-module dictionary with its nested ``preprocessing_kwargs`` and
        ``tokenization_kwargs``.

        Keys that only concern processes, models or logging are ignored. Sizes of -1 mean "not set".
        A missing ``overfit`` means True, as such configs expect.
        """
        prep = dict(kwargs.get("preprocessing_kwargs") or {})
        tok = dict(kwargs.get("tokenization_kwargs") or {})
        clean_keys = CleanSettings.__dataclass_fields__
        clean = {k: v for k, v in prep.items() if k in clean_keys and v is not None}
        clean["add_constants"] = clean.get("add_constants") or {}

        def size(name):
            value = kwargs.get(name)
            return value if value is not None and value > 0 else None

        per_item = bool(kwargs.get("batch_tokenize", False))
        left_prefix = bool(tok.get("prefix_input_left_padding", False))
        prefixed = bool(tok.get("prefix_tuning", False)) if per_item else left_prefix
        prefix = "front" if prefixed else None
        causal = bool(tok.get("concat_input_output", False))
        form = PackSettings.per_item if per_item else PackSettings.whole_table
        padding = tok.get("padding", "max_length")
        padding = {True: "longest", False: "none", "do_not_pad": "none"}.get(padding, padding)
        pack_settings = form(
            mode="causal" if causal else "seq2seq",
            max_input=tok.get("max_input_length", 512),
            max_target=tok.get("max_target_length", 30),
            padding=padding,
            truncation=bool(tok.get("truncation", True)),
            n_prefix=tok.get("n_prefix_tokens", 30),
            prefix_id=tok.get("prefix_token_id", 50256),
            decoder_prefix=bool(prefix and tok.get("decoder_prefix", False)),
            prefix_only=bool(tok.get("prefix_only", False)),
            prefix=prefix,
        )
        return cls(
            raw_data=kwargs.get("raw_data"),
            read_options=read_options or {},
            splits=kwargs.get("splits"),
            predict_split=kwargs.get("predict_split"),
            id2label=kwargs.get("id2label"),
            deduplicate_columns=tuple(kwargs.get("deduplicate_columns") or ()),
            clean=CleanSettings(**clean),
            filter_long_sequences=bool(kwargs.get("filter_long_sequences", False)),
            input_limit=tok.get("max_output_length", 512),
            target_limit=tok.get("max_target_length", 30),
            split=SplitSettings(
                dev_size=size("dev_size"),
                dev_from_train=size("dev_from_train") is not None,
                tiny=bool(kwargs.get("tiny", False)),
                tiny_size=kwargs.get("tiny_size", 1024),
                shots=size("shots"),
                overfit=bool(kwargs.get("overfit", True)),
                predict_size=size("predict_size"),
            ),
            pack=pack_settings,
            predict_prefix="after_pad" if prefixed and left_prefix and causal else prefix,
            batch_size=kwargs.get("batch_size") or 8,
            strategy=kwargs.get("strategy") or "",
            seed=seed,
            row_id=row_id,
        )
