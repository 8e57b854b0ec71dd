"""Digests of whole licence texts, in the form without holder statements.

Made from the licence files of Debian (/usr/share/common-licenses) and of installed packages,
by licenses.canonical(text, HOLDER); several wordings of one licence have a row each.
"""

FULL = (
    ("Apache-2.0", "07a71a982fcb1d067ca668d48b7cea8eb8416e38e358b9ab96b3056f93457e6a"),
    ("Apache-2.0", "237c66fb072fea7bd1521da952b386b67e3115180cd5a08a3159b1e59e6eafca"),
    ("Apache-2.0", "6fb8411669deea22294b6190fad00b8e39899d0b7b6c5cf97a3b15b47e129c38"),
    ("Apache-2.0", "75acde0fb516a7ba4597dfc23680cf78281f7fae7f3b74a78e06ef83c1c375c6"),
    ("Apache-2.0", "7b43ee8f1e8c954af35f9a316ad24ee0e263b15c3511a472b7f547619129345e"),
    ("Apache-2.0", "95fe918080644b73e2cc66e44365b39771ff03145db9764a775f521afece4bba"),
    ("Apache-2.0", "f9138026e58bdb767e6c6e974637ff9aacbaedf2695e30fef144e5d7d84448ff"),
    ("Artistic-1.0-Perl", "d1ce9579b2c8d32b706b421d9c42208152298e00849e57ce7da8e906ed3802f2"),
    ("BSD-2-Clause", "7be8178e4e9d0dea6ff4b04bd52bd086d7ea8386a5a6e09760df916bae5d42d2"),
    ("BSD-2-Clause", "986c3c3199a93b916c8f2e0aeed57819bcbdcb2cd9d99902dcc9d74b53f93a74"),
    ("BSD-2-Clause", "a56fee4b2f66331ed54da4950ef9c9391453fd1490b4d8ea202bc29683bcbd30"),
    ("BSD-3-Clause", "0af6267f495661a9c4f72f474602031f4e40485e3f4d0ab8e79bb5cc1c3f507f"),
    ("BSD-3-Clause", "15f57ceac50496fc4b9d7b36a66f4d5cfd98ed43eaa713f737dff3aa3a2b2ff1"),
    ("BSD-3-Clause", "8ea8b8d56b60a1c8c3272bd44402057aa62f99b6d36d425e8659eed020e2f756"),
    ("BSD-3-Clause", "9571a4bcffc19a829f55bd46047cb5279e7a9e08aa1b47b88ee84f3d0ab912cc"),
    ("BSD-3-Clause", "9b83d3dee0616d07b82a272dd9bf5134a9f402b750f5ee6188458073b0a32ff2"),
    ("BSD-3-Clause", "c165caf2263156afde96f4b02327c2ba96c47bd8cff887df37a4210399885793"),
    ("BSD-3-Clause", "cc65957a28f15bbcef5b0c23770aae3bd8462cb25904250f77a812ab3b2efe15"),
    ("BSL-1.0", "4242941f56cc0aaf7a416006734167273b17a074704308b941e02a99526671b6"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GFDL-1.2", "94541e73869af10ab6bd68a29575eede324e54e7d5237e7386d12444f593af60"),
    ("GFDL-1.3", "a92fdbaeafedd9cbeb812ebbded06ee07e3b1427c81cfc333e682109c594d826"),
    ("GPL-1.0", "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224"),
    ("GPL-2.0", "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821"),
    ("GPL-3.0", "eaab5d82fdcca441d83a1913bbf07e4de3a739e190578c0bffde24f84e93bb2a"),
    ("LGPL-2.0", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("LGPL-2.1", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "cbbde7eeab9b4d180dc00b34252f800e97fb1cddbab38ed8c0c73b956dc2cbf6"),
    ("MPL-2.0", "f82071285728ca3ec7685ee9bc4acdae0b8267142a4d20b8f1805eabedb4a98a"),
    ("Unlicense", "7a4d92cdb11d254973a073803be1148a5402f1b2ca67808cdb3ef78b596102cd"),
    ("Zlib", "1b8c5cd52eceb19ab0bc3cb40be110b1c0e7fa2671a3fe5866e59dd1502e69c7"),
    ("Zlib", "99618428d879198d4ae824db7ad07a9d0f9214f15429de52839cbe667713f21a"),
)
